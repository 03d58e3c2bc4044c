"""Packing documents into fixed windows by lexical retrieval.

The corpus is split into shards: documents are ordered by the least hash of their heaviest
terms, so that documents with common heavy terms stand together, and a shard is a bounded
run of that order.  Neighbours in other shards are not found.  Each shard holds an inverted index of its documents, weighted by BM25 with document frequencies and the mean
length of the whole corpus.  A seed document opens a window; the index returns the unused
documents that fit it best, which fill the window greedily; the document that overruns the
window is cut and its rest opens the next one.  The end of a shard is cut into
power-of-two sequences, which take no padding.

Terms are counted in a fixed number of hash buckets, so the corpus statistics have a fixed
size, whatever the corpus; a bucket's frequency counts all documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.bpe import default_tokenizer, id_type, ragged_take, split_words, word_encoder
from biblioflow.llm.words import PIECE_BYTES, buffers, mix, pieces, ship_by_value, span_hashes, word_spans, worker_cache

WINDOW = 2048
END_ID = 1
TERM_BUCKETS = 1 << 17
SHARD_TOKENS = 1 << 20
#: Terms that so large a share of all documents hold tell nothing and aren't asked for.
COMMON = 0.9
#: Terms of a document that its place among the shards depends on.
HEAVY_TERMS = 12
K1, B = 1.2, 0.75
#: Documents, about, whose places say where partitions begin, for each of them.
BORDER_SAMPLE = 64
#: Words whose ids a worker keeps between tasks.
KEPT_WORDS = 300_000


def term_rows(col: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, frequency) of each distinct term of each text, by row; words of each text."""
    data, off = buffers(col)
    start, end, first = word_spans(data, off)
    term = (span_hashes(data, start, end) % np.uint64(buckets)).astype(np.int64)
    counts = np.diff(first)
    key = np.repeat(np.arange(len(counts)), counts) * buckets + term
    key.sort()
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[at] // buckets, key[at] % buckets, np.diff(np.append(at, len(key))), counts


def corpus_statistics(rows: DataFrame, buckets: int = TERM_BUCKETS) -> tuple[np.ndarray, int, int]:
    """(documents that hold each term bucket, documents, words), over all rows.

    Each task adds up its own counts; the driver gets ``buckets`` numbers, a fixed size."""
    part = 1 << 12

    def run(batches):
        seen, docs, words = np.zeros(buckets, np.int64), 0, 0
        for batch in batches:
            for _, col in pieces(batch, "text"):
                _, term, _, counts = term_rows(col, buckets)
                seen += np.bincount(term, minlength=buckets)
                docs, words = docs + len(counts), words + int(counts.sum())
        if docs:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(-1, buckets // part, dtype=np.int32)),
                pa.array([np.array([docs, words], "<i8").tobytes(), *(seen[i:i + part].astype("<i8").tobytes() for i in range(0, buckets, part))], pa.binary())],
                ["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_py(), "<i8") for x in table["counts"]], axis=0)
        return pa.table({"part": table["part"].slice(0, 1), "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    found = {r["part"]: np.frombuffer(r["counts"], "<i8") for r in rows.select("text").mapInArrow(run, "part int, counts binary")
             .groupBy("part").applyInArrow(add, "part int, counts binary").collect()}
    if not found:
        return np.zeros(buckets, np.int64), 0, 0
    return np.concatenate([found[i] for i in range(buckets // part)]), int(found[-1][0]), int(found[-1][1])


def token_ids(col: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each followed by ``end_id``; offsets per text)."""
    words, counts = split_words(col)
    coded = words.dictionary_encode()
    encode, known = word_encoder(path), worker_cache(("known words", path), dict)
    if len(known) > KEPT_WORDS:
        known.clear()
    ids = []
    for word in coded.dictionary.to_pylist():
        got = known.get(word)
        if got is None:
            got = encode(word)
            if len(word) <= 64:
                known[word] = got
        ids.append(got)
    ids.append([end_id])
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for x in ids for i in x), id_type(path), int(size.sum()))
    index = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(counts), len(ids) - 1)
    edge = np.concatenate([[0], np.cumsum(size[index])])[np.concatenate([[0], np.cumsum(counts + 1)])]
    return ragged_take(flat, (np.cumsum(size) - size)[index], size[index]), edge


def content_keys(row, term, freq, length, idf, mean, several) -> np.ndarray:
    """For each text the least hash of its HEAVY_TERMS heaviest terms that other documents hold
    too: two texts agree with the probability that their sets of heavy terms are alike."""
    weight = bm25(row, term, freq, length, idf, mean)
    heavy = np.lexsort((-weight, row))
    heavy = heavy[several[term[heavy]]]
    rank = np.arange(len(heavy)) - np.searchsorted(row[heavy], row[heavy])
    heavy = heavy[rank < HEAVY_TERMS]
    key = np.full(len(length), 2 ** 64 - 1, np.uint64)
    np.minimum.at(key, row[heavy], mix(term[heavy].astype(np.uint64)))
    return key.view(np.int64)


def bm25(row, term, freq, length, idf, mean) -> np.ndarray:
    return idf[term] * freq * (K1 + 1) / (freq + K1 * (1 - B + B * length[row] / max(mean, 1e-9)))


class ShardIndex:
    """Inverted index of a shard's documents with BM25 weights; documents are taken once."""

    def __init__(self, row, term, freq, length, idf, mean):
        weight = bm25(row, term, freq, length, idf, mean)
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = row[order], weight[order]
        self.terms, at = np.unique(term[order], return_index=True)
        self.cut = np.append(at, len(order))
        self.free = np.ones(len(length), bool)
        # a document's query: all its terms but those that nearly all documents hold
        asked = idf[term] > np.log1p((1 - COMMON) / COMMON)
        self.query = np.searchsorted(self.terms, term[asked])
        self.query_cut = np.searchsorted(row[asked], np.arange(len(length) + 1))

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents that share a query term with the seed, best first."""
        q = self.query[self.query_cut[seed]:self.query_cut[seed + 1]]
        starts, sizes = self.cut[q], self.cut[q + 1] - self.cut[q]
        docs = ragged_take(self.docs, starts, sizes)
        if len(docs) == 0:
            return docs
        score = np.bincount(docs, ragged_take(self.weights, starts, sizes), minlength=len(self.free))
        found = np.flatnonzero((score > 0) & self.free)
        return found[np.argsort(-score[found], kind="stable")]


def pack_shard(length: np.ndarray, index: ShardIndex, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a shard, ``length`` in tokens."""
    out, used, sequence, next_free, waiting, last = [], 0, 0, 0, [], -1
    for _ in range(len(length)):
        doc = -1
        while doc < 0:
            if not waiting and used and last >= 0:  # the list is used up: its latest document asks
                waiting, last = index.neighbours(last)[:window].tolist()[::-1], -1
            if not waiting:
                break
            doc = waiting.pop()
            doc = doc if index.free[doc] else -1
        if doc < 0:  # nothing fits: the next unused document
            while not index.free[next_free]:
                next_free += 1
            doc = next_free
        last = doc
        index.free[doc] = False
        start, total = 0, int(length[doc])
        seed = used == 0
        while start < total:
            take = min(total - start, window - used)
            out.append((doc, start, take, sequence, used))
            start, used = start + take, used + take
            if used == window:
                sequence, used, seed = sequence + 1, 0, start < total
        if seed or not used:  # this document (or its rest) opened the window, or that is still empty
            waiting = []
    return cut_tail(out, sequence, used)


def cut_tail(out: list, sequence: int, used: int) -> list:
    """The last, short window as sequences of power-of-two lengths."""
    sizes = [1 << b for b in range(used.bit_length() - 1, -1, -1) if used >> b & 1]
    edges = [0, *np.cumsum(sizes).tolist()]
    kept = [p for p in out if p[3] != sequence]
    for doc, start, size, _, offset in (p for p in out if p[3] == sequence):
        while size:
            k = int(np.searchsorted(edges, offset, side="right")) - 1
            take = min(size, edges[k + 1] - offset)
            kept.append((doc, start, take, sequence + k, offset - edges[k]))
            start, size, offset = start + take, size - take, offset + take
    return kept


def lexical_packing(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", *,
                    window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS,
                    keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` (with ``keep_ids`` also ``ids``, the piece's ids as 32-bit numbers).

    A document is its ids and ``end_id``; null and empty texts are that id alone.  All
    sequences hold ``window`` ids but those at a shard's end, which hold a power of two.
    Neighbours come from the seed's shard; equal scores go to the earlier row there.  Repeated
    rows are documents of their own; a document longer than a window goes on into the next;
    an empty table gives an empty result; other columns aren't read."""
    path = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    seen, n_docs, n_words = corpus_statistics(rows)
    statistics = spark.sparkContext.broadcast(  # TERM_BUCKETS numbers
        (np.log1p((n_docs - seen + 0.5) / (seen + 0.5)).astype(np.float32), n_words / max(n_docs, 1), seen > 1))

    def place(text: pa.Array) -> pa.Array:
        out = [content_keys(*term_rows(col, len(statistics.value[0])), *statistics.value)
               for _, col in pieces(pa.RecordBatch.from_arrays([text], ["text"]), "text", PIECE_BYTES)]
        return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64), pa.int64())

    def run(batches):
        from pyspark import TaskContext

        idf, mean, _ = statistics.value
        base, shard = TaskContext.get().partitionId() << 40, 0
        held: list = []
        tokens = 0

        def close():
            ids = np.concatenate([h[1] for h in held])
            length = np.concatenate([np.diff(h[2]) for h in held])
            shift = np.cumsum([0, *(len(h[0]) for h in held)])
            row = np.concatenate([h[3][0] + s for h, s in zip(held, shift)])
            index = ShardIndex(row, np.concatenate([h[3][1] for h in held]), np.concatenate([h[3][2] for h in held]),
                               np.concatenate([h[3][3] for h in held]), idf, mean)
            found = np.array(pack_shard(length, index, window), np.int64).reshape(-1, 5)
            doc, start, size, sequence, offset = found.T
            raw, begin = ids.astype("<u4").tobytes(), (np.cumsum(length) - length)[doc] + start
            parts = [raw[4 * a:4 * (a + n)] for a, n in zip(begin.tolist(), size.tolist())]
            cols = [pa.concat_arrays([h[0] for h in held]).take(pa.array(doc)), pa.array(start), pa.array(size),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(length[doc]),
                    pa.array(base + (shard << 24) + sequence), pa.array(offset)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                cols, names = [*cols, pa.array(parts, pa.binary())], [*names, "ids"]
            return pa.RecordBatch.from_arrays(cols, names)

        for batch in batches:
            for part, col in pieces(batch, "text", PIECE_BYTES):
                ids, edge = token_ids(col, path, end_id)
                held.append((part.column("doc_id"), ids, edge, term_rows(col, len(idf))))
                tokens += len(ids)
                if tokens >= shard_tokens:
                    yield close()
                    held, tokens, shard = [], 0, shard + 1
        if held:
            yield close()

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    # rows are dealt by (place, hash), so that the second part divides a frequent place, at the
    # quantiles of a bounded sample; only the layout of shards depends on it
    rows = rows.withColumn("mix", F.xxhash64("doc_id", "text"))
    keys = F.arrow_udf(place, "long")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    share = min(1.0, BORDER_SAMPLE * parts / max(n_docs, 1))
    sample = rows.where((F.col("mix").cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64) < share)
    found = sorted(tuple(r) for r in sample.select(keys("text").alias("place"), F.xxhash64("mix").alias("again")).collect())  # BORDER_SAMPLE rows a partition, about
    cuts = [found[len(found) * i // parts] for i in range(1, parts)] if found else []
    borders = spark.sparkContext.broadcast(np.array(cuts, np.int64).reshape(-1, 2))  # one row per partition

    def part_of(at: pa.Array, again: pa.Array) -> pa.Array:
        a, b = np.asarray(at), np.asarray(again)
        first, second = borders.value.T
        low, high = np.searchsorted(first, a, side="left"), np.searchsorted(first, a, side="right")
        part = low
        for i in np.flatnonzero(high > low).tolist():  # a place that is a border itself
            part[i] = low[i] + np.searchsorted(second[low[i]:high[i]], b[i], side="right")
        return pa.array(part.astype(np.int32))

    placed = rows.withColumn("place", keys("text")).withColumn("again", F.xxhash64("mix"))
    placed = placed.withColumn("part", F.arrow_udf(part_of, "int")("place", "again"))
    dealt = placed.repartitionById(parts, "part").sortWithinPartitions("place", "again")
    return dealt.select("doc_id", "text").mapInArrow(run, kind + (", ids binary" if keep_ids else ""))


ship_by_value(__name__)
