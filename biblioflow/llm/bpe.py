"""Byte-level BPE over a table of distinct words.

``encode``: texts are split into pre-tokens block by block (a block is a bounded run of a
task's rows), each block keeps a dictionary of its words and the words' positions.  The
dictionaries are shuffled by word hash, so every distinct word of a hash bucket is encoded
once, and its ids go back to the blocks, where they are joined to the positions.  Only
dictionaries and compressed positions are shuffled, never one row per occurrence.

``decode``: ids are joined to an id-to-piece table (as many rows as the vocabulary, a fixed
size), and the pieces of a document are put together and read as UTF-8.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.pretokens import pretokens
from biblioflow.llm.words import PIECE_BYTES, pieces, ship_by_value, span_hashes, text_column, worker_cache

BLOCK_BYTES = 8 << 20
SPECIAL = "<|endoftext|>"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow at 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(piece bytes -> id, special string -> id) of a byte-level BPE tokenizer file."""
    def build():
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = byte_of_character()
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(back[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        made = [spec["model"]["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)]
                for m in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError("ids must follow the order of the merges")
        return ranks, special

    return worker_cache(("vocabulary", path), build)


def word_encoder(path: str):
    """A function bytes -> list of ids for one pre-token (merges by rank)."""
    def build():
        import tiktoken

        ranks, special = vocabulary(path)
        # the pattern takes any text whole: what comes here is one pre-token already
        coder = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        fixed = {k.encode(): [v] for k, v in special.items()}

        def encode(word: bytes) -> list[int]:
            return fixed.get(word) or coder.encode_ordinary(word.decode("utf-8"))
        return encode

    return worker_cache(("encoder", path), build)


def id_type(path: str) -> str:
    ranks, special = vocabulary(path)
    return "<u2" if max([*ranks.values(), *special.values()]) < 1 << 16 else "<u4"


def piece_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all pieces, start of each id's piece, length): the id-to-piece table."""
    def build():
        ranks, special = vocabulary(path)
        by_id = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in special.items()}
        every = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        size = np.array([len(x) for x in every], np.int64)
        return np.frombuffer(b"".join(every), np.uint8), np.cumsum(size) - size, size

    return worker_cache(("pieces", path), build)


def ragged_take(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[i]:starts[i] + sizes[i]]`` one after another."""
    total = int(sizes.sum())
    if total == 0:
        return values[:0]
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    at += np.arange(total)
    return values[at]


def binaries(chunks: list[bytes]) -> pa.Array:
    return pa.array(chunks, pa.binary())


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes (first all lowest bytes, and so on)."""
    return zstandard.ZstdCompressor(level=3).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def split_words(col: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pre-tokens of all texts as large_binary, number of each text's)."""
    data, start, first = pretokens(col, SPECIAL)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start) - 1, [None, pa.py_buffer(start.astype(np.int64)), pa.py_buffer(data)])
    return words, np.diff(first)


def _blocks(batches: Iterator[pa.RecordBatch], limit: int):
    """Blocks of at most ``limit`` text bytes, or one longer text: (block number, ids, words
    per text, dictionary, dictionary index of each word).  The number is a digest of the
    block's rows, so the same rows have the same number whenever they are split."""
    held: list = []
    size = 0

    def close():
        mark = hashlib.blake2b(digest_size=8)
        for ids, _, words in held:
            mark.update(repr(ids.to_pylist()).encode())
            mark.update(words.buffers()[1])
            mark.update(words.buffers()[2])
        coded = pa.chunked_array([w for _, _, w in held]).dictionary_encode().combine_chunks()
        coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
        return (int.from_bytes(mark.digest(), "little", signed=True), pa.concat_arrays([i for i, _, _ in held]),
                np.concatenate([c for _, c, _ in held]), coded.dictionary, coded.indices.to_numpy(zero_copy_only=False))

    for batch in batches:
        for rows, col in pieces(batch, "text", min(PIECE_BYTES, limit)):
            words, counts = split_words(col)
            here = words.buffers()[2].size if len(words) else 0
            if held and size + here > limit:
                yield close()
                held, size = [], 0
            held.append((rows.column("doc_id"), counts, words))
            size += here
    if held:
        yield close()


def _ranked(dictionary: pa.Array, index: np.ndarray, buckets: int):
    """Frequent words first: (rank of each occurrence, words in rank order, their buckets)."""
    seen = np.bincount(index, minlength=len(dictionary))
    order = np.argsort(-seen, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    words = dictionary.take(pa.array(order))
    off = np.frombuffer(words.buffers()[1], np.int64)[:len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] else np.zeros(0, np.uint8)
    bucket = (span_hashes(data, off[:-1], off[1:], lower=False) % np.uint64(buckets)).astype(np.uint32)
    return rank[index], data, off, bucket


def _dictionary_rows(limit: int, buckets: int):
    def run(batches):
        for block, _, _, dictionary, index in _blocks(batches, limit):
            _, data, off, bucket = _ranked(dictionary, index, buckets)
            order = np.argsort(bucket, kind="stable")
            size = np.diff(off)
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(cut))
            parts = [order[cut[b]:cut[b + 1]] for b in used]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(used), block, np.int64)), pa.array(used.astype(np.int32)),
                binaries([packed(size[p].astype("<u4")) for p in parts]),
                binaries([packed(ragged_take(data, off[:-1][p], size[p])) for p in parts])], ["block", "bucket", "sizes", "words"])
    return run


def _position_rows(limit: int, buckets: int):
    def run(batches):
        for block, ids, counts, dictionary, index in _blocks(batches, limit):
            rank, _, _, bucket = _ranked(dictionary, index, buckets)
            narrow = "<u2" if buckets < 1 << 16 else "<u4"
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.array([ids.cast(pa.int64()).to_pylist()], pa.list_(pa.int64())),
                pa.array([counts.tolist()], pa.list_(pa.int64())), binaries([packed(rank.astype("<u4"))]),
                binaries([packed(bucket.astype(narrow))])], ["block", "doc_ids", "counts", "ranks", "buckets"])
    return run


def _encode_bucket(path: str):
    """All blocks' words of one hash bucket: each distinct word is encoded once."""
    def run(table: pa.Table) -> pa.Table:
        encode, kind = word_encoder(path), id_type(path)
        sizes = [unpacked(x.as_py(), "<u4") for x in table["sizes"]]
        every = np.concatenate(sizes).astype(np.int64)
        off = np.concatenate([[0], np.cumsum(every)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(every), [
            None, pa.py_buffer(off), pa.py_buffer(np.concatenate([unpacked(x.as_py(), "u1") for x in table["words"]]))])
        coded = words.dictionary_encode()
        ids = [encode(w) for w in coded.dictionary.to_pylist()]
        size = np.array([len(x) for x in ids], np.int64)
        flat, start = np.array([i for x in ids for i in x], kind), np.cumsum(size) - size
        index = coded.indices.to_numpy(zero_copy_only=False)
        at, out = 0, ([], [])
        for s in sizes:
            here = index[at:at + len(s)]
            at += len(s)
            out[0].append(packed(size[here].astype("<u4")))
            out[1].append(packed(ragged_take(flat, start[here], size[here])))
        return pa.table({"block": table["block"], "bucket": table["bucket"], "sizes": binaries(out[0]), "ids": binaries(out[1])})
    return run


def _join_back(path: str, buckets: int):
    """One block: the ids of its dictionary words, joined to the words' positions."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kind, out = id_type(path), []
        found = dict(zip(right["bucket"].to_pylist(), zip(right["sizes"].to_pylist(), right["ids"].to_pylist())))
        size = np.concatenate([np.zeros(0, np.int64), *(unpacked(found[b][0], "<u4") for b in sorted(found))]).astype(np.int64)
        flat = np.concatenate([np.zeros(0, kind), *(unpacked(found[b][1], kind) for b in sorted(found))])
        for row in left.to_pylist():
            bucket = unpacked(row["buckets"], "<u2" if buckets < 1 << 16 else "<u4")
            if len(bucket) != len(size):
                raise RuntimeError("a block's words were split differently in the two readings of the table")
            place = np.empty(len(bucket), np.int64)
            place[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
            width, begin = size[place], (np.cumsum(size) - size)[place]
            rank = unpacked(row["ranks"], "<u4")
            upto = np.concatenate([[0], np.cumsum(row["counts"])]).astype(np.int64)
            at, n = 0, len(row["doc_ids"])
            while at < n:  # some documents at a time
                to = max(at + 1, int(np.searchsorted(upto, upto[at] + (1 << 17), side="right")) - 1)
                w = rank[upto[at]:upto[to]]
                ids = ragged_take(flat, begin[w], width[w]).astype("<u4")
                edge = np.concatenate([[0], np.cumsum(width[w])])[upto[at:to + 1] - upto[at]]
                raw = ids.tobytes()
                out.append(pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"][at:to], pa.int64()), pa.array(np.diff(edge).astype(np.int64)),
                    binaries([raw[4 * a:4 * b] for a, b in zip(edge[:-1], edge[1:])])], ["doc_id", "n_tokens", "ids"]))
                at = to
        return pa.Table.from_batches(out)
    return run


def encode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", *,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit).

    Null and empty texts have no ids.  A special token's string in a text is that token.
    Ids are integers (null stays null); repeated rows come out as often; a very long text is
    a block by itself; an empty table gives an empty result; other columns aren't read."""
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number, for the number of buckets
    buckets = max(8, math.ceil(total / block_bytes))
    words = rows.mapInArrow(_dictionary_rows(block_bytes, buckets), "block long, bucket int, sizes binary, words binary")
    coded = words.groupBy("bucket").applyInArrow(_encode_bucket(path), "block long, bucket int, sizes binary, ids binary")
    positions = rows.mapInArrow(_position_rows(block_bytes, buckets),
                                "block long, doc_ids array<long>, counts array<long>, ranks binary, buckets binary")
    return positions.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(
        _join_back(path, buckets), "doc_id long, n_tokens long, ids binary")


def decode(tokens: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Adds ``decoded`` to rows ``doc_id, n_tokens, ids``: the pieces of the ids, special
    tokens included, as text (bytes that aren't UTF-8 become U+FFFD; null ids: empty)."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        flat, start, size = piece_table(path)
        for whole in batches:
            for batch, _ in pieces_of_bytes(whole, "ids", PIECE_BYTES):
                texts = []
                for raw in batch.column("ids"):
                    ids = np.frombuffer(raw.as_py() or b"", "<u4")
                    texts.append(ragged_take(flat, start[ids], size[ids]).tobytes().decode("utf-8", errors="replace"))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_tokens", "ids")), pa.array(texts, pa.string())],
                                                 ["doc_id", "n_tokens", "ids", "decoded"])
    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def pieces_of_bytes(batch: pa.RecordBatch, column: str, limit: int):
    """Slices of at most ``limit`` bytes of a binary column (at least one row each)."""
    sizes = np.array([len(x.as_py() or b"") for x in batch.column(column)], np.int64)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at), None
        at = to


ship_by_value(__name__)
