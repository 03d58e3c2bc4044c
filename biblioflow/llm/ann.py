"""Nearest neighbours by largest inner product: a forest of random-projection trees.

* Vectors get one more coordinate that makes all norms equal (0 for queries), so the largest
  inner product is the smallest angle.
* The trees' planes are random directions, each cut at its median over a bounded sample of
  the vectors (``max_sample``); every vector is then routed to its leaf of every tree.
* A query keeps one priority queue for all trees, ordered by its distance to the planes on
  the other side of which a branch lies, and opens leaves from it until these hold
  ``search_share`` times as many rows as there are vectors (a vector is in one leaf of each
  tree), at every size of the table, and so many that k different ones are among them.
* A leaf's vectors meet the queries that opened it; exact inner products in double
  precision rank them, and the best of all leaves are the answer.

Identical vectors are one vector with its smallest ids, so copies, however many, cost one
candidate.  A leaf is dealt over parts of about ``part_rows`` vectors, so that no task gets
a leaf whole however full it is; nothing is dropped.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.llm.components import _written
from biblioflow.llm.words import mix, ship_by_value

TREES, DEPTH = 12, 7
SEARCH_SHARE = 1.6
MAX_SAMPLE = 32_768
PART_ROWS = 4096


def build_forest(sample: np.ndarray, trees: int, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(planes, offsets) of complete binary trees: node k has children 2k + 1 and 2k + 2."""
    rng = np.random.default_rng(seed)
    nodes = 2 ** depth - 1
    planes = rng.normal(size=(trees, nodes, sample.shape[1]))
    planes /= np.linalg.norm(planes, axis=2, keepdims=True)
    offsets = np.zeros((trees, nodes))
    for t in range(trees):
        at = np.zeros(len(sample), np.int64)
        for k in range(nodes):
            rows = np.flatnonzero(at == k)
            side = sample[rows] @ planes[t, k]
            offsets[t, k] = np.median(side) if len(rows) else 0.0
            at[rows] = 2 * k + 1 + (side > offsets[t, k])
    return planes, offsets


def leaves_of(x: np.ndarray, planes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Leaf of each row in each tree (rows by trees)."""
    trees, nodes = offsets.shape
    out = np.zeros((len(x), trees), np.int32)
    for t in range(trees):
        side = x @ planes[t].T > offsets[t]
        at = np.zeros(len(x), np.int64)
        for _ in range(int(nodes + 1).bit_length() - 1):
            at = 2 * at + 1 + side[np.arange(len(x)), at]
        out[:, t] = at - nodes
    return out


def open_leaves(margins: np.ndarray, sizes: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs, nearest first by one queue over all trees, until they hold
    ``wanted`` rows; ``margins`` are the query's signed distances to all planes."""
    nodes = margins.shape[1]
    queue = [(0.0, t, 0) for t in range(len(margins))]
    out, held = [], 0
    while queue and held < wanted:
        far, t, k = heapq.heappop(queue)
        while k < nodes:  # down the near side; the far sides wait
            m = margins[t, k]
            heapq.heappush(queue, (max(far, abs(m)), t, 2 * k + 1 if m > 0 else 2 * k + 2))
            k = 2 * k + 2 if m > 0 else 2 * k + 1
        if sizes[t, k - nodes]:
            out.append((t, k - nodes))
            held += int(sizes[t, k - nodes])
    return out


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _best(top: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Queries that opened a leaf part against its vectors: each query's ``top``."""
        q, v = matrix(left["x"]), matrix(right["x"])
        ids = np.asarray(right["rep"].combine_chunks())
        out = ([], [])
        for a in range(0, len(q), 512):
            block = q[a:a + 512]
            scores = block @ v.T if len(v) else np.zeros((len(block), 0))
            for i, row in enumerate(scores):
                # the rounding of the product may not decide: near ties are all measured again
                edge = np.partition(row, -top)[-top] - 1e-9 * max(1.0, float(np.abs(row).max())) if len(row) > top else -np.inf
                near = np.flatnonzero(row >= edge)
                exact = (v[near] * block[i]).sum(axis=1)
                order = np.lexsort((ids[near], -exact))[:top]
                out[0].append(ids[near][order].astype("<i8").tobytes())
                out[1].append(exact[order].astype("<f8").tobytes())
        return pa.table({"query": left["rep"], "ids": pa.array(out[0], pa.binary()), "scores": pa.array(out[1], pa.binary())})
    return run


def _merge(top: int):
    def run(table: pa.Table) -> pa.Table:
        ids = np.frombuffer(b"".join(x.as_py() for x in table["ids"]), "<i8")
        scores = np.frombuffer(b"".join(x.as_py() for x in table["scores"]), "<f8")
        ids, first = np.unique(ids, return_index=True)
        scores = scores[first]
        order = np.lexsort((ids, -scores))[:top]
        return pa.table({"query": pa.array([table["query"][0].as_py()] * len(order), pa.int64()),
                         "rep": pa.array(ids[order]), "score": pa.array(scores[order])})
    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x`` (array of doubles) of the vectors that take part: an id, no null or
    non-finite component, not all zero, of the most frequent length (the larger of equals)."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).where(fine & F.exists("x", lambda e: e != 0))
    length = rows.groupBy(F.size("x").alias("n")).agg(F.count(F.lit(1)).alias("c")).agg(F.max_by("n", F.struct("c", "n"))).scalar()
    return rows.where(F.size("x") == length)


def forest_search(vectors: DataFrame, is_query, k: int, id_col: str = "vec_id", vector_col: str = "embedding", *,
                  trees: int = TREES, depth: int = DEPTH, search_share: float = SEARCH_SHARE, max_sample: int = MAX_SAMPLE,
                  part_rows: int = PART_ROWS, seed: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` (a predicate on
    ``vec_id``) accepts, the ``k`` nearest found of all other rows, nearest first, equal scores
    by smaller id; fewer rows if there are fewer candidates.

    Vectors that take no part (``usable``) are neither queries nor candidates.  Rows that
    repeat an id and vector are one row.  Empty tables give an empty result; other columns
    aren't read.  ``search_share`` sets recall against work; the default finds over 0.95 of
    the true neighbours even among vectors without any cluster structure."""
    spark = vectors.sparkSession
    valid = _written(usable(vectors, id_col, vector_col), "vectors")
    # of identical vectors the k + 1 smallest ids matter; the rank limit is applied before the shuffle
    rank = F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))
    some = valid.distinct().withColumn("_r", rank).where(F.col("_r") <= k + 1)
    distinct = _written(some.groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.element_at("ids", 1).alias("rep"), "x", "ids"), "distinct-vectors")
    facts = distinct.agg(F.count(F.lit(1)), F.max(F.aggregate("x", F.lit(0.0), lambda a, e: a + e * e))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not facts[0]:
        return empty
    share = min(1.0, (1.2 * max_sample + 100) / facts[0])
    picked = distinct.where((F.xxhash64("rep").cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64) < share).orderBy(F.xxhash64("rep"), "rep").limit(max_sample)
    sample = np.array([r[0] for r in picked.select("x").collect()], np.float64)  # at most max_sample vectors
    largest = float(facts[1])

    def lifted(x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(largest - (x * x).sum(axis=1), 0.0))[:, None]])

    forest = spark.sparkContext.broadcast(build_forest(lifted(sample), trees, depth, seed))  # trees * 2^depth planes

    def route(batches):
        planes, offsets = forest.value
        for batch in batches:
            x = matrix(batch.column("x"))
            if len(x):
                yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(leaves_of(lifted(x), planes, offsets).tolist(), pa.list_(pa.int32()))], ["rep", "leaves"])

    leaves = _written(distinct.select("rep", "x").mapInArrow(route, "rep long, leaves array<int>"), "leaves")
    placed = leaves.select("rep", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = np.zeros((trees, 2 ** depth), np.int64)
    for r in placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).collect():  # at most trees * 2^depth rows
        sizes[r["tree"], r["leaf"]] = r["n"]
    state = spark.sparkContext.broadcast((*forest.value, sizes, np.maximum(1, -(-sizes // part_rows))))

    def deal(batches):
        parts = state.value[3]
        for batch in batches:
            tree, leaf, rep = (np.asarray(batch.column(c)) for c in ("tree", "leaf", "rep"))
            part = (mix(rep.view(np.uint64)) % parts[tree, leaf].astype(np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rep", "tree", "leaf")), pa.array(part), batch.column("x")], ["rep", "tree", "leaf", "part", "x"])

    def ask(batches):
        planes, offsets, count, parts = state.value
        wanted = max(search_share * count[0].sum(), trees * (k + 1))  # k + 1 different ones at least
        for batch in batches:
            x = matrix(batch.column("x"))
            for i in range(len(x)):
                one = np.append(x[i], 0.0)
                found = open_leaves(planes @ one - offsets, count, wanted)
                cells = [(t, leaf, p) for t, leaf in found for p in range(parts[t, leaf])]
                t, leaf, p = (np.array(c, np.int32) for c in zip(*cells))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), batch.column("rep")[i].as_py(), np.int64)), pa.array(t), pa.array(leaf), pa.array(p)],
                                                 ["rep", "tree", "leaf", "part"])

    cell = ["tree", "leaf", "part"]
    asking = valid.where(is_query(F.col("vec_id"))).select("vec_id", "x").distinct()
    queries = _written(asking.join(distinct.select("rep", "x"), "x").select(F.col("vec_id").alias("query_id"), "rep"), "queries")
    asked = distinct.join(queries.select("rep").distinct(), "rep", "left_semi").select("rep", "x")
    opened = asked.mapInArrow(ask, "rep long, tree int, leaf int, part int").join(asked, "rep")
    index = placed.join(distinct.select("rep", "x"), "rep").select("rep", "tree", "leaf", "x").mapInArrow(
        deal, "rep long, tree int, leaf int, part int, x array<double>")
    found = (opened.groupBy(*cell).cogroup(index.groupBy(*cell)).applyInArrow(_best(k + 1), "query long, ids binary, scores binary")
             .groupBy("query").applyInArrow(_merge(k + 1), "query long, rep long, score double"))
    named = found.join(distinct.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    rows = queries.join(named, queries["rep"] == named["query"]).where("vec_id <> query_id").select("query_id", "vec_id", "score")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")  # at most (k + 1)^2 rows each
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ship_by_value(__name__)
