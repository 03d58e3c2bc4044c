"""Trie of conversation prefixes, with count-min screening of prefix digests.

1. A turn becomes a 128-bit digest and a length; texts are read once.  Turns are range-sorted
   by conversation and turn, so a conversation that holds a third of all rows is many ranges.
2. A prefix's digest is the sum of its turns' digests, each mixed with its position, so it is
   a running sum over ranges and a parent's digest is a difference.  Conversations are
   rebuilt in the same pass: the first turns come from the conversation's base.
3. All prefix digests are counted in a count-min sketch of fixed largest size.  Its estimates
   are never too low, so an estimate of one proves that a prefix belongs to one conversation
   only: such a node is answered where it is read.
4. Only possibly shared prefixes are grouped exactly by their digests.  The smallest member
   of a node owns it; what a node adds to its ancestors (a leaf, saved code points) lies on
   its owner's path, so subtree sums are running sums along paths, added up by digest.
5. A node's ending ids are hashed in their order from chunks of a range sort, so that a large
   group is chunked by many tasks and the last one streams chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.llm.mixing import prefix_sums
from biblioflow.llm.words import mix, ship_by_value
from biblioflow.session import scratch_path

LANES = 4  # of 32 bits each; their sums fit a long for 2^31 turns
MAX_CELLS = 1 << 26  # of each of the sketch's rows, a power of two
SKETCH_ROWS = 2
CHUNK = 1 << 16
BUCKET = 4096 * 8  # bits of one of Spark's bitmaps
HEAVY = 1000  # parents with at least a 1000th of all nodes as children are broadcast

P, Q, K = ([f"{x}{i}" for i in range(LANES)] for x in "pqk")  # prefix, parent and turn lanes


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lanes(digest: Column, names: Sequence[str]) -> list[Column]:
    """The digest's first 128 bits (of a hex string) as longs of 32 bits."""
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(n) for i, n in enumerate(names)]


def at_position(position: Column) -> list[Column]:
    """Lanes of the turn digest ``_digest`` at a position in the rebuilt conversation."""
    return lanes(F.md5(F.concat(position.cast("string"), F.lit(":"), F.col("_digest")).cast("binary")), K)


def head_length(conv: Column, most: int) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % most


def rebuilt_prefixes(turns: DataFrame, conv: str, turn: str, role: str, text: str, group: int, heads: int) -> DataFrame:
    """One row per conversation and depth: ``c, d, p0.. (prefix), q0.. (parent), length, last``."""
    col = lambda name: F.col(f"`{name}`")
    said = [F.coalesce(col(x).cast("string"), F.lit("")) for x in (role, text)]
    # the role's length keeps ("a", "bc") and ("ab", "c") apart
    digest = F.sha2(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said).cast("binary"), 256)
    narrow = turns.where(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("c"), col(turn).alias("_turn"),
        F.substring(digest, 1, 32).alias("_digest"), F.char_length(said[1]).cast("long").alias("length"), F.lit(1).cast("long").alias("_one"))
    narrow = _written(narrow, "turns")
    order = ["_turn", "_digest", "length"]  # nulls come first
    counts = narrow.groupBy("c").agg(F.count(F.lit(1)).alias("_n"))
    base_of = F.col("c") - F.col("c") % group

    # the first turns of every base, at most heads - 1 of each; the rank limit precedes the shuffle
    rank = F.row_number().over(Window.partitionBy("c").orderBy(*order))
    top = narrow.where(F.col("c") % group == 0).withColumn("d", rank).where(F.col("d") < heads).select("c", "d", "length", *at_position(F.col("d")))
    upto = Window.partitionBy("c").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    top = top.select("c", F.struct("d", "length", *K, *[F.sum(k).over(upto).alias(p) for k, p in zip(K, P)]).alias("t"))
    first = top.groupBy("c").agg(F.sort_array(F.collect_list("t")).alias("_first")).withColumnRenamed("c", "_base")
    convs = _written(counts.withColumn("_base", base_of).join(first, "_base", "left").select(
        "c", "_n", F.slice(F.coalesce("_first", F.array()), F.lit(1), head_length(F.col("c"), heads).cast("int")).alias("_head")), "convs")

    facts = convs.select("c", head_length(F.col("c"), heads).alias("_h"), F.size("_head").cast("long").alias("_shown"), "_n",
                         *[F.coalesce(F.try_element_at("_head", F.lit(-1))[p], F.lit(0)).alias(f"_s{p}") for p in P])
    ranked = prefix_sums(narrow, ["c", *order], {"_rank": "_one"}, ["c"], facts)
    depth = F.col("_rank") - F.col("_h") + F.col("_shown") + 1
    own = ranked.where(F.col("_rank") >= F.col("_h")).withColumn("d", depth)
    own = own.select("c", "d", "length", (F.col("_rank") + 1 == F.col("_n")).alias("last"), *at_position(F.col("d")), *[f"_s{p}" for p in P])
    summed = prefix_sums(own, ["c", "d"], dict(zip([f"_b{p}" for p in P], K)), ["c"])
    own = summed.select("c", "d", *[(F.col(f"_s{p}") + F.col(f"_b{p}") + F.col(k)).alias(p) for p, k in zip(P, K)],
                        *[(F.col(f"_s{p}") + F.col(f"_b{p}")).alias(q) for p, q in zip(P, Q)], "length", "last")

    shown, end = F.size("_head"), F.col("_n") <= head_length(F.col("c"), heads)  # no own turns after the head
    head = convs.select("c", F.explode("_head").alias("t"), (end & (F.col("t")["d"] == shown)).alias("last")).select(
        "c", F.col("t")["d"].cast("long").alias("d"), *[F.col("t")[p].alias(p) for p in P],
        *[(F.col("t")[p] - F.col("t")[k]).alias(q) for p, q, k in zip(P, Q, K)], F.col("t")["length"].alias("length"), "last")
    zero = F.lit(0).cast("long")
    root = convs.select("c", zero.alias("d"), *[zero.alias(x) for x in P + Q], zero.alias("length"), (end & (shown == 0)).alias("last"))
    return _written(own.unionByName(head).unionByName(root), "prefixes")


def _cells(batch, names: Sequence[str], depth: np.ndarray, width: int) -> list[np.ndarray]:
    """A prefix's cell in each row of the sketch."""
    x = [np.asarray(batch.column(n)).view(np.uint64) for n in names]
    depth = depth.astype(np.uint64)
    return [mix(x[2 * r] * np.uint64(0x9E3779B97F4A7C15) + x[2 * r + 1] + (depth << np.uint64(40))) & np.uint64(width - 1) for r in range(SKETCH_ROWS)]


def count_min(prefixes: DataFrame, rows: int) -> np.ndarray:
    """Bits of the cells that were hit twice or more, one row of the sketch after the other;
    ``SKETCH_ROWS * MAX_CELLS`` bits at most.  Cells are counted by a pre-aggregated grouping and
    packed into Spark's bitmaps before they reach the driver."""
    width = BUCKET
    while width < 8 * rows and width < MAX_CELLS:
        width *= 2

    def hit(batches):
        for batch in batches:
            found = _cells(batch, P, np.asarray(batch.column("d")), width)
            for r, cells in enumerate(found):
                yield pa.RecordBatch.from_arrays([pa.array((cells + np.uint64(r * width)).astype(np.int64))], ["cell"])

    counted = prefixes.select("d", *P).mapInArrow(hit, "cell long").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    maps = counted.where("n > 1").groupBy(F.floor(F.col("cell") / BUCKET).alias("b")).agg(F.bitmap_construct_agg((F.col("cell") % BUCKET)).alias("bits"))
    out = np.zeros((SKETCH_ROWS * width // BUCKET, BUCKET // 8), np.uint8)
    for b, bits in maps.collect():
        out[b] = np.frombuffer(bits, np.uint8)
    return out.reshape(SKETCH_ROWS, -1)


def screened(prefixes: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``prefixes`` with ``single`` and ``parent_single``: the sketch proves that the prefix, or
    its parent, belongs to one conversation only."""
    shared = prefixes.sparkSession.sparkContext.broadcast(sketch)  # bounded by MAX_CELLS
    width = sketch.shape[1] * 8

    def test(batches):
        bits = shared.value
        for batch in batches:
            depth = np.asarray(batch.column("d"))
            out = []
            for names, at in ((P, depth), (Q, depth - 1)):
                many = np.ones(len(at), bool)
                for r, cell in enumerate(_cells(batch, names, at, width)):
                    many &= (bits[r, (cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
                out.append(pa.array(~many & (at >= 0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], [*batch.schema.names, "single", "parent_single"])

    return prefixes.mapInArrow(test, f"{prefixes.schema.toDDL()}, single boolean, parent_single boolean")


def ending_hashes(ends: DataFrame) -> DataFrame:
    """``d, p0.., ends_sha256`` from rows ``d, p0.., c``: SHA-256 of each prefix's ids in
    numerical order, comma-joined."""
    keys = ["d", *P]
    schema = ends.select(*keys).schema.toDDL()

    def runs(batches):
        """Per batch of sorted rows: (first row, past the last) of each run of one key."""
        for batch in batches:
            if batch.num_rows:
                x = np.stack([np.asarray(batch.column(k)) for k in keys])
                cut = np.append(np.append(0, np.flatnonzero((x[:, 1:] != x[:, :-1]).any(axis=0)) + 1), batch.num_rows)
                yield batch, x, cut

    def chunk(batches):
        for batch, x, cut in runs(batches):
            ids = np.asarray(batch.column("c"))
            rows = [(x[:, a], ids[at], ",".join(map(str, ids[at:min(b, at + CHUNK // 8)]))) for a, b in zip(cut[:-1], cut[1:]) for at in range(a, b, CHUNK // 8)]
            cols = np.stack([k for k, _, _ in rows], axis=1)
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), pa.array([f for _, f, _ in rows]), pa.array([t for _, _, t in rows])], [*keys, "first", "ids"])

    def digest(batches):
        key, state = None, None

        def done():
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in key), pa.array([state.hexdigest()])], [*keys, "ends_sha256"])
        for batch, x, cut in runs(batches):
            texts = batch.column("ids")
            for a, b in zip(cut[:-1], cut[1:]):
                now = tuple(x[:, a].tolist())
                if now != key:
                    if key is not None:
                        yield done()
                    key, state = now, hashlib.sha256()
                    fresh = True
                for i in range(a, b):
                    state.update((b"" if fresh else b",") + texts[i].as_py().encode())
                    fresh = False
        if key is not None:
            yield done()

    sorted_ = ends.repartitionByRange(*keys, "c").sortWithinPartitions(*keys, "c")
    chunks = sorted_.mapInArrow(chunk, f"{schema}, first long, ids string")
    return chunks.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(digest, f"{schema}, ends_sha256 string")


def shared_nodes(rows: DataFrame) -> DataFrame:
    """The nodes of the possibly shared prefixes, exactly: ``d, p0.., q0.., parent_single, conv_id,
    n_convs, n_children, n_leaves, saved_tokens`` from ``screened`` rows.  A prefix below a
    proven one can be among them by chance (``parent_single``); it has one member."""
    keys = ["d", *P]
    shared = rows.where(~F.col("single"))
    zero = F.lit(0).cast("long")
    nodes = shared.groupBy(*keys).agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("_n"), F.count_if("last").alias("_ends"), F.max("length").alias("_len"))
    # what a node adds to itself and its ancestors, on its owner's row; proven tails add their leaf
    worth = nodes.select("c", "d", ((F.col("_n") - 1) * F.col("_len")).alias("_saved"), (F.col("_n") == F.col("_ends")).cast("long").alias("_leaf"))
    owned = shared.join(worth, ["c", "d"], "left").select(
        "c", (-F.col("d")).alias("_up"), F.lit(True).alias("_node"), *P, *Q, "parent_single", F.col("_saved").isNotNull().alias("_own"),
        F.coalesce("_saved", zero).alias("_saved"), F.coalesce("_leaf", zero).alias("_leaf"))
    tails = rows.where("single and last").select("c", (-F.col("d")).alias("_up"), F.lit(False).alias("_node"), *P, *Q, "parent_single", F.lit(False).alias("_own"),
                                                  zero.alias("_saved"), F.lit(1).cast("long").alias("_leaf"))
    paths = prefix_sums(owned.unionByName(tails), ["c", "_up"], {"_saved_below": "_saved", "_leaves_below": "_leaf"}, ["c"])
    members = paths.where("_node").select(
        (-F.col("_up")).alias("d"), *P, *Q, "parent_single", "c", F.lit(1).cast("long").alias("n_convs"), zero.alias("n_children"),
        (F.col("_leaf") + F.col("_leaves_below")).alias("n_leaves"), (F.col("_saved") + F.col("_saved_below")).alias("saved_tokens"), "_own")
    paths_written = _written(members, "paths")
    # one child for the parent of every owned node, and of every proven one whose parent isn't
    child = [(F.col("d") - 1).alias("d"), *[F.col(q).alias(p) for p, q in zip(P, Q)], *[F.lit(None).cast("long").alias(q) for q in Q],
             F.lit(None).cast("boolean").alias("parent_single"), F.lit(None).cast("long").alias("c"), zero.alias("n_convs"), F.lit(1).cast("long").alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens")]
    children = paths_written.where("_own and d > 0 and not parent_single").select(*child).unionByName(rows.where("single and not parent_single and d > 0").select(*child))
    every = paths_written.drop("_own").unionByName(children)
    return every.groupBy(*keys).agg(*[F.max(q).alias(q) for q in [*Q, "parent_single"]], F.min("c").alias("conv_id"),
                                    *[F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")])


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", *,
                group: int = 100, heads: int = 6) -> DataFrame:
    """One row per distinct prefix of rebuilt conversations: ``conv_id`` (its smallest member),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Conversation c is rebuilt from the first h = crc32(decimal c) % ``heads`` turns of
    conversation c - c % ``group`` (all if it has fewer, none if it's absent) and its own
    turns after its first h.  Turns are in the order of ``turn``, nulls first; equal turns by
    the digest of role and text, then length.  Null role or text counts as empty.  Rows without a
    conversation id take no part.  A conversation that is left without turns is a member of
    the root only.  Repeated rows are turns of their own.  Texts are hashed whole; prefixes are told apart by 128-bit sums
    of MD5 digests.  An empty table has no members, so not even a root: an empty result.
    Other columns aren't read."""
    spark = turns.sparkSession
    prefixes = rebuilt_prefixes(turns, conv, turn, role, text, group, heads)
    rows = _written(screened(prefixes, count_min(prefixes, prefixes.count())), "screened")
    keys = ["d", *P]
    nodes = _written(shared_nodes(rows), "nodes")
    ends = ending_hashes(rows.where("last and not single").select(*keys, "c"))
    ended = nodes.join(ends, keys, "left")

    # parents: of shared nodes, and of proven ones whose parent is not proven
    none = F.sha2(F.lit("").cast("binary"), 256)
    one = F.lit(1).cast("long")
    tail = [F.col("c").alias("conv_id"), "d", *Q, "parent_single", one.alias("n_convs"), (~F.col("last")).cast("long").alias("n_children"), one.alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(F.col("last"), F.sha2(F.col("c").cast("string").cast("binary"), 256)).otherwise(none).alias("ends_sha256")]
    single = rows.where("single")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    def shown(df: DataFrame, parent: Column) -> DataFrame:
        return df.withColumn("parent_conv_id", parent).withColumn("depth", F.col("d")).select(*names)

    rest = ended.select("conv_id", "d", *Q, "parent_single", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
    local = shown(single.select(*tail).unionByName(rest).where("parent_single"), F.col("conv_id"))
    rest = _written(rest.unionByName(single.select(*tail)).where("not parent_single"), "looking-up")
    top = shown(rest.where("d = 0"), F.lit(None).cast("long"))
    # a parent with many children has as many rows that look it up: those are at most HEAVY, and broadcast
    many = rest.agg(F.count(F.lit(1)) / HEAVY).scalar()
    up = nodes.select((F.col("d") + 1).alias("d"), *[F.col(p).alias(q) for p, q in zip(P, Q)], F.col("conv_id").alias("_parent"), (F.col("n_children") > many).alias("_heavy"))
    below = rest.where("d > 0").join(F.broadcast(up.where("_heavy").drop("_heavy")), ["d", *Q], "left")
    found = shown(below.where("_parent is not null"), F.col("_parent"))
    other = below.where("_parent is null").drop("_parent").join(up.where(~F.col("_heavy")).drop("_heavy"), ["d", *Q])
    return local.unionByName(top).unionByName(found).unionByName(shown(other, F.col("_parent")))


ship_by_value(__name__)
