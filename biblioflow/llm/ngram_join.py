"""N-gram Jaccard join by grouped prefixes.

A document is the set of its word shingles' hashes.  All documents order shingles alike,
rare ones first (by the count of the shingle's hash bucket over the corpus, then by hash);
two sets of Jaccard similarity t or more share a shingle among the first
``n - ceil(t * n) + 1`` of each.

1. Bucket counts over all documents (a table of fixed size).
2. Equal sets are one class; documents with identical prefix and size are one group.
3. A group posts its prefix.  Groups that meet under a shingle, with sizes that can be
   similar, are linked to that shingle's smallest group; the components of these links hold
   every pair that can be similar, and no pair is written out for it.
4. Groups are expanded: the classes of a component are brought together with their whole
   sets, in blocks of bounded size, and exact overlaps decide which are similar.
5. Components of the verified links.

Shingles in many documents are rare in prefixes, because they come last; where one is hot
all the same, its postings are dealt over salts and the salts' smallest groups linked.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.components import _written, components
from biblioflow.llm.rows import numbered
from biblioflow.llm.words import buffers, mix, pieces, shingle_hashes, ship_by_value, span_hashes, word_spans

COUNT_BUCKETS = 1 << 21
#: Postings of one shingle that go to one task, about.
HOT_POSTINGS = 50_000
#: Classes whose sets are compared in one block.
BLOCK = 8192


def text_sets(col: pa.Array, k: int):
    """The sorted distinct shingle hashes of each text (A-Z as a-z; words are split at ASCII
    white space; a text of fewer words is one shingle, one without words has none)."""
    data, off = buffers(col)
    start, end, first = word_spans(data, off)
    flat, cut = shingle_hashes(span_hashes(data, start, end), first, k)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield np.unique(flat[a:b])


def bucket_counts(rows: DataFrame, k: int, buckets: int = COUNT_BUCKETS) -> np.ndarray:
    """In how many documents each hash bucket's shingles stand (sums; over all rows)."""
    part = buckets // 16

    def count(batches):
        seen, held, size, any_row = np.zeros(buckets, np.uint32), [], 0, False
        for batch in batches:
            for _, col in pieces(batch, "text"):
                any_row = True
                held += [(s & np.uint64(buckets - 1)).astype(np.uint32) for s in text_sets(col, k)]
                size += sum(map(len, held[-len(col):]))
                if size >= buckets:
                    seen += np.bincount(np.concatenate(held), minlength=buckets).astype(np.uint32)
                    held, size = [], 0
        if any_row:
            if held:
                seen += np.bincount(np.concatenate(held), minlength=buckets).astype(np.uint32)
            pack = zstandard.ZstdCompressor(level=1)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(16, dtype=np.int32)),
                pa.array([pack.compress(seen[i:i + part].astype("<u4").tobytes()) for i in range(0, buckets, part)], pa.binary())],
                ["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        unpack, total = zstandard.ZstdDecompressor(), np.zeros(part, np.int64)
        for x in table["counts"]:
            total += np.frombuffer(unpack.decompress(x.as_py()), "<u4")
        return pa.table({"part": table["part"].slice(0, 1), "counts": pa.array([np.minimum(total, 2 ** 32 - 1).astype("<u4").tobytes()], pa.binary())})

    got = {r["part"]: np.frombuffer(r["counts"], "<u4") for r in rows.select("text").mapInArrow(count, "part int, counts binary")
           .groupBy("part").applyInArrow(add, "part int, counts binary").collect()}  # ``buckets`` numbers
    if not got:
        return np.zeros(buckets, np.uint32)
    return np.concatenate([got[i] for i in range(16)])


def least_overlap(n: int, num: int, den: int) -> int:
    """The least overlap that a set of n has with a similar one: ceil(n * num / den)."""
    return -(-n * num // den)


def size_band(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Sizes of similar sets lie in the same or in neighbouring bands."""
    return np.floor(np.log(np.maximum(n, 1)) / math.log(den / num) + 1e-9).astype(np.int32)


def _set_rows(counts, k: int, num: int, den: int):
    def run(batches):
        seen = counts.value
        for batch in batches:
            for rows, col in pieces(batch, "text"):
                n, key, mark, prefix = [], [], [], []
                for s in text_sets(col, k):
                    n.append(len(s))
                    if len(s) == 0:
                        key.append(None), mark.append(None), prefix.append(None)
                        continue
                    key.append(np.array([len(s), s.sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], "<u8").tobytes())
                    order = np.argsort(seen[(s & np.uint64(len(seen) - 1)).astype(np.int64)], kind="stable")  # ties: by hash
                    first = s[order[:len(s) - least_overlap(len(s), num, den) + 1]]
                    mark.append(int(mix(first * np.uint64(3) + np.arange(len(first), dtype=np.uint64)).sum(dtype=np.uint64).astype(np.int64)))
                    prefix.append(first.astype(np.int64))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                                                  pa.array(mark, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))],
                                                 ["doc_id", "n", "key", "mark", "prefix"])
    return run


def _post(counts, num: int, den: int, hot: int):
    """Postings ``shingle, salt, band, gid`` of groups; salts only for hot buckets."""
    def run(batches):
        seen = counts.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            prefix = batch.column("prefix")
            size = np.asarray(prefix.value_lengths())
            flat = np.asarray(prefix.flatten())
            gid = np.repeat(np.asarray(batch.column("gid")), size)
            band = np.repeat(size_band(np.asarray(batch.column("n")), num, den), size)
            often = seen[(flat.view(np.uint64) & np.uint64(len(seen) - 1)).astype(np.int64)]
            salts = np.maximum(1, often.astype(np.int64) // hot)
            salt = (mix(gid.view(np.uint64)) % salts.astype(np.uint64)).astype(np.int32)
            salt = np.where(salts > 1, salt, -1).astype(np.int32)  # -1: not dealt out
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(salt), pa.array(band), pa.array(gid)],
                                             ["shingle", "salt", "band", "gid"])
    return run


def _meet(batches):
    """Sorted postings -> links ``a, b`` of each band's groups to its smallest, and of that to
    the next band's; a salted shingle's smallest groups also come out as postings."""
    last = None  # (shingle, salt, band, its smallest group) of the row before
    for batch in batches:
        if batch.num_rows == 0:
            continue
        shingle, salt, band, gid = (np.asarray(batch.column(c)) for c in ("shingle", "salt", "band", "gid"))
        if last is not None:
            shingle, salt, band, gid = (np.concatenate([[x], y]).astype(y.dtype) for x, y in zip(last, (shingle, salt, band, gid)))
        run = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (salt[1:] != salt[:-1])])
        new = run | np.concatenate([[True], band[1:] != band[:-1]])
        at = np.flatnonzero(new)
        pivot = gid[at]  # sorted: the first is the smallest
        mine = np.repeat(pivot, np.diff(np.append(at, len(gid))))
        a, b = gid[gid != mine], mine[gid != mine]
        step = np.flatnonzero(~run[at[1:]] & (band[at[1:]] == band[at[:-1]] + 1))
        a, b = np.concatenate([a, pivot[step + 1]]), np.concatenate([b, pivot[step]])
        links = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        dealt = at[salt[at] >= 0]
        if last is not None and len(dealt) and dealt[0] == 0:
            dealt = dealt[1:]  # came out with the batch before
        none = pa.nulls(len(links), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1]), none, pa.nulls(len(links), pa.int32()), none], ["a", "b", "shingle", "band", "gid"])
        if len(dealt):
            none = pa.nulls(len(dealt), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(shingle[dealt]), pa.array(band[dealt]), pa.array(gid[dealt])], ["a", "b", "shingle", "band", "gid"])
        last = (shingle[-1], salt[-1], band[-1], pivot[-1])


def _meetings(postings: DataFrame) -> DataFrame:
    sorted_ = postings.repartition(F.col("shingle"), F.col("salt")).sortWithinPartitions("shingle", "salt", "band", "gid")
    return sorted_.mapInArrow(_meet, "a long, b long, shingle long, band int, gid long")


def candidate_links(groups: DataFrame, counts, num: int, den: int, hot: int) -> DataFrame:
    """``a, b``: links whose components hold every pair of groups that may be similar."""
    postings = groups.select("gid", "n", "prefix").mapInArrow(_post(counts, num, den, hot), "shingle long, salt int, band int, gid long")
    found = _written(_meetings(postings), "meetings")
    again = found.where("shingle IS NOT NULL").select("shingle", F.lit(-1).alias("salt"), "band", "gid")  # one per salt and band
    return found.where("a IS NOT NULL").select("a", "b").unionByName(_meetings(again).where("a IS NOT NULL").select("a", "b")).distinct()


def similar_pairs(sets: list[np.ndarray], side: np.ndarray | None, num: int, den: int) -> list[int]:
    """Root (list index) of each set's component among the similar pairs of ``sets``; with
    ``side``, only pairs of different sides count.  Overlaps are exact counts through an
    inverted index of the block; sets that are connected already need no decision."""
    n = len(sets)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    size = np.array([len(s) for s in sets])
    if n == 2 and side is None:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [0, 0] if den * both >= num * (size.sum() - both) else [0, 1]
    flat = np.concatenate(sets)
    ranked = np.sort(flat)
    common = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])  # what one set holds alone adds to no overlap
    del ranked
    if len(common) == 0:
        return root
    place = np.searchsorted(common, flat).astype(np.int32)
    known = common[np.minimum(place, len(common) - 1)] == flat
    del flat
    term = place[known]
    owner = np.repeat(np.arange(n, dtype=np.int32), size)[known]
    upto = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    docs = owner[np.argsort(term, kind="stable")]
    cut = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(common)))])
    del place, known, owner
    for x in range(n):
        t = term[upto[x]:upto[x + 1]]
        if len(t) == 0:
            continue
        first, run = cut[t], cut[t + 1] - cut[t]
        at = np.repeat(first - (np.cumsum(run) - run), run) + np.arange(int(run.sum()))
        both = np.bincount(docs[at], minlength=n)
        alike = den * both >= num * (size + size[x] - both)
        alike[:x + 1] = False
        if side is not None:
            alike &= side != side[x]
        for y in np.flatnonzero(alike).tolist():
            a, b = find(x), find(y)
            if a != b:
                root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def _verify(k: int, num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        ids, unit, part = (table[c].to_numpy() for c in ("doc_id", "unit", "part"))
        sets = [s for batch in table.to_batches() for _, col in pieces(batch, "text") for s in text_sets(col, k)]
        out = ([], [])
        order = np.lexsort((ids, unit))
        cuts = np.flatnonzero(np.concatenate([[True], unit[order][1:] != unit[order][:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows = order[a:b]
            if len(rows) < 2:
                continue
            side = part[rows] if part[rows].min() >= 0 else None
            for x, r in enumerate(similar_pairs([sets[i] for i in rows], side, num, den)):
                if r != x:
                    out[0].append(int(ids[rows[x]])), out[1].append(int(ids[rows[r]]))
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})
    return run


def blocks_of(classes: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """``doc_id, unit, part, bin``: where the classes (``doc_id, n, comp, size``) are compared.

    Small components share bins.  A component of over ``block`` classes is cut into bands of
    sizes and a band into parts of about ``block`` classes; a part meets itself, the other
    parts of its band and those of the next one, each meeting in a bin of its own."""
    bins = max(1, (classes.agg(F.count(F.lit(1))).first()[0] * 8) // block)  # one number
    small = classes.where(F.col("size") <= block).select(
        "doc_id", F.col("comp").alias("unit"), F.lit(-1).alias("part"), F.concat(F.lit("s:"), F.pmod(F.xxhash64("comp"), F.lit(bins))).alias("bin"))
    large = classes.where(F.col("size") > block).withColumn(
        "band", F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(den / num)) + F.lit(1e-9)).cast("int"))
    count = classes_by_band(large, block)
    own = large.join(F.broadcast(count), ["comp", "band"]).withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    after = count.select("comp", (F.col("band") - 1).alias("band"), F.col("parts").alias("next_parts"))
    before = count.select("comp", (F.col("band") + 1).alias("band"), F.col("parts").alias("last_parts"))
    own = own.join(F.broadcast(after), ["comp", "band"], "left").join(F.broadcast(before), ["comp", "band"], "left")

    def every(parts: str, meeting):
        return F.when(F.col(parts).isNull(), F.array()).otherwise(
            F.transform(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1), meeting))

    meets = F.concat(
        every("parts", lambda j: F.struct(
            F.concat_ws(":", F.lit("b"), "comp", "band", F.least(j, F.col("slot")), F.greatest(j, F.col("slot"))).alias("bin"),
            F.when(j == F.col("slot"), -1).when(F.col("slot") < j, 0).otherwise(1).alias("part"))),
        every("next_parts", lambda j: F.struct(
            F.concat_ws(":", F.lit("n"), "comp", "band", F.col("slot"), j).alias("bin"), F.lit(0).alias("part"))),
        every("last_parts", lambda j: F.struct(
            F.concat_ws(":", F.lit("n"), "comp", F.col("band") - 1, j, F.col("slot")).alias("bin"), F.lit(1).alias("part"))))
    large = own.select("doc_id", F.col("comp").alias("unit"), F.explode(meets).alias("m")).select(
        "doc_id", "unit", F.col("m.part").alias("part"), F.col("m.bin").alias("bin"))
    return small.unionByName(large)


def verified_links(classes: DataFrame, texts: DataFrame, k: int, num: int, den: int, block: int) -> DataFrame:
    """``a, b``: links whose components are those of all similar pairs of ``classes``
    (``doc_id, n, comp, size``: a class's representative, its set's size, its component and
    the number of classes there)."""
    placed = blocks_of(classes, num, den, block)
    return (texts.join(placed, "doc_id").select("doc_id", "unit", "part", "bin", "text").groupBy("bin")
            .applyInArrow(_verify(k, num, den), "a long, b long"))


def classes_by_band(large: DataFrame, block: int) -> DataFrame:
    """``comp, band, parts`` of the components larger than a block: at most one row for each
    ``block`` classes and band, so its size is the input's divided by ``block``."""
    return large.groupBy("comp", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("parts"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5,
                       similarity: tuple[int, int] = (80, 100), hot: int = HOT_POSTINGS, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id`` (the smallest id that is
    reachable by links, itself included).

    Two documents are linked if ``den * |A and B| >= num * |A or B|`` for their sets of
    ``words``-word shingles.  Null texts and texts without words have no shingles, are linked
    with nothing and are their own component.  Ids are integers; rows that share an id are
    one node; a null id stays null and names no component unless all its equals are null.
    An empty table gives an empty result; other columns aren't read."""
    num, den = similarity
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = spark.sparkContext.broadcast(bucket_counts(texts, words))  # COUNT_BUCKETS numbers
    sets = _written(texts.mapInArrow(_set_rows(counts, words, num, den), "doc_id long, n long, key binary, mark long, prefix array<long>"), "sets")
    some = sets.where("n > 0")
    groups = some.groupBy("n", "mark").agg(F.min("doc_id").alias("gid"), F.any_value("prefix").alias("prefix"))
    groups = _written(groups.where("gid IS NOT NULL"), "groups")
    linked = components(candidate_links(groups, counts, num, den, hot))

    classes = some.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n"), F.any_value("mark").alias("mark"),
                                      F.count(F.lit(1)).alias("copies")).where("doc_id IS NOT NULL")
    placed = classes.join(groups.select("gid", "n", "mark"), ["n", "mark"]).join(
        linked.withColumnRenamed("node", "gid"), "gid", "left").select("doc_id", "n", "key", "copies", F.coalesce("component", "gid").alias("comp"))
    placed = _written(placed, "classes")
    several = placed.groupBy("comp").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    links = _written(verified_links(placed.select("doc_id", "n", "comp").join(several, "comp"), texts, words, num, den, block), "links")
    found = components(links)

    named = placed.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "key", "copies", "doc_id", F.coalesce("component", "doc_id").alias("component_id"))
    named = named.where((F.col("copies") > 1) | (F.col("component_id") != F.col("doc_id"))).select("key", "component_id")
    return sets.select("doc_id", F.col("n").alias("n_shingles"), "key").join(named, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose component has a smaller id: one of each group stays,
    and rows without shingles or without id stay.

    Rows that share an id but not a text are judged apart (``numbered``): those that have to
    be renumbered count as behind all others, and no text goes because another one with its
    id does.  Rows that share id and text stay or go together."""
    rows, _ = numbered(docs.select(F.struct("*").alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")), "_id", "_text")
    found = jaccard_components(rows, "_row_id", "_text", **options)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return rows.join(gone, F.col("_row_id") == F.col("_gone"), "left_anti").select("_row.*")


ship_by_value(__name__)
