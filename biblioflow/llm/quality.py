"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document is the mean of its words' features: each word counts in a hashed bucket of its
lower-case form and in a bucket of its shape (which kinds of characters it holds and how it
begins); a word that repeats the word before it counts in one bucket for repetition instead.  One weight
vector is shared by all grades; ordered thresholds turn the score s into the tail
probabilities P(grade >= k) = logistic(s - threshold_k), which give the expected grade and
the selection.

Ratings: 0 where ``quality`` is 0; 1 for good but toxic documents; 2 for good, clean ones.
The model comes from all rated documents: they are dealt into parts of about ``max_rated`` by
a hash of their ids, each part is fitted by a task, and the parts' parameters are averaged by
their documents.  The threshold counts all held-out documents.  Everything else reads all
documents, each by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.llm.words import buffers, pieces, release, ship_by_value, span_hashes, word_spans

WORD_BUCKETS = 1 << 14
SHAPES = 1 << 10
FEATURES = WORD_BUCKETS + SHAPES + 1
#: Rated documents that one task fits, about.
MAX_RATED = 8000
#: Ranges of the held-out documents' tails that are ranked apart.
RANGES = 128
#: Share of the held-out good and clean documents that a calibrated selection keeps at least.
CLEAN_KEPT = 0.97
STEPS, RATE, PENALTY = 300, 0.2, 1e-5


@dataclass
class OrdinalModel:
    weights: np.ndarray     # per feature
    thresholds: np.ndarray  # ascending, one for each grade above the lowest
    grades: np.ndarray      # the grades themselves, ascending


def _kinds(data: np.ndarray) -> np.ndarray:
    """0 lower case, 1 upper case, 2 digit, 3 other ASCII sign, 4 beyond ASCII."""
    table = np.full(256, 3, np.uint8)
    table[97:123], table[65:91], table[48:58], table[128:] = 0, 1, 2, 4
    return table[data]


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, shape bucket, repeats the word before) of each word."""
    hashes = span_hashes(data, start, end)
    kind = _kinds(data)
    has = np.zeros(len(start), np.int64)
    for k in range(5):
        upto = np.concatenate([[0], np.cumsum(kind == k)])
        n = upto[end] - upto[start]
        has |= (n > 0).astype(np.int64) << k
        if k == 3:
            signs = np.minimum(n, 3)
    shape = (has << 5) + (kind[start].astype(np.int64) << 2) + signs  # 2^5 sets of kinds, 5 first kinds, 0-3 signs
    shape = shape % SHAPES
    again = np.zeros(len(start), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][first[:-1] < len(start)]] = False
    return (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), WORD_BUCKETS + shape, again


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0.0], np.cumsum(values)])
    return upto[first[1:]] - upto[first[:-1]]


def feature_rows(batches):
    """Sparse mean features of rated documents: ``grade, hash, indices, values``."""
    for batch in batches:
        for rows, col in pieces(batch, "text"):
            data, off = buffers(col)
            start, end, first = word_spans(data, off)
            word, shape, again = word_features(data, start, end, first)
            out = ([], [])
            for a, b in zip(first[:-1], first[1:]):
                new = ~again[a:b]
                every = np.concatenate([word[a:b][new], shape[a:b][new], np.full(int(b - a - new.sum()), FEATURES - 1)])
                index, n = np.unique(every, return_counts=True)
                out[0].append(index.astype("<i4").tobytes())
                out[1].append((n / max(b - a, 1)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([rows.column("grade"), rows.column("hash"), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())],
                                             ["grade", "hash", "indices", "values"])


def fit_ordinal(grades: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], levels: np.ndarray | None = None) -> OrdinalModel | None:
    """Maximum likelihood by full-batch Adam steps; None with fewer than two grades (``levels``,
    by default those of the rows).

    Features are scaled by the square root of their root mean square, between what common
    and what rare words would need; thresholds stay ordered because their gaps are
    exponentials."""
    levels = np.unique(grades) if levels is None else levels
    if len(levels) < 2:
        return None
    sizes = np.array([len(i) for i, _ in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    index = np.concatenate([i for i, _ in rows]).astype(np.int64)
    value = np.concatenate([v for _, v in rows]).astype(np.float64)
    n = len(rows)
    scale = (np.bincount(index, value ** 2, minlength=FEATURES) / n) ** 0.25 + 1e-3
    value = value / scale[index]
    above = (grades[:, None] >= levels[None, 1:]).astype(np.float64)
    share = np.clip(above.mean(axis=0), 1e-6, 1 - 1e-6)
    cut = np.log((1 - share) / share)
    gap = np.log(np.maximum(np.diff(cut), 1e-3))
    theta = np.concatenate([np.zeros(FEATURES), [cut[0]], gap])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, cuts = theta[:FEATURES], theta[FEATURES] + np.concatenate([[0.0], np.cumsum(np.exp(theta[FEATURES + 1:]))])
        score = np.bincount(owner, w[index] * value, minlength=n)
        tail = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -50, 50)))  # P(grade >= level)
        upper = np.concatenate([np.ones((n, 1)), tail], axis=1)
        lower = np.concatenate([tail, np.zeros((n, 1))], axis=1)
        at = above.sum(axis=1).astype(int)
        r = np.arange(n)
        p = np.maximum(upper[r, at] - lower[r, at], 1e-12)
        slope = np.concatenate([np.zeros((n, 1)), tail * (1 - tail), np.zeros((n, 1))], axis=1)
        d_upper, d_lower = slope[r, at] / p, slope[r, at + 1] / p  # of log p, by s - cut
        d_score = -(d_upper - d_lower) / n
        d_cut = np.zeros(len(cuts))
        np.add.at(d_cut, np.maximum(at - 1, 0), np.where(at > 0, d_upper, 0.0) / n)
        np.add.at(d_cut, np.minimum(at, len(cuts) - 1), np.where(at < len(cuts), -d_lower, 0.0) / n)
        grad = np.concatenate([np.bincount(index, value * d_score[owner], minlength=FEATURES) + PENALTY * w, [d_cut.sum()],
                               [d_cut[k + 1:].sum() * np.exp(g) for k, g in enumerate(theta[FEATURES + 1:])]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    cuts = theta[FEATURES] + np.concatenate([[0.0], np.cumsum(np.exp(theta[FEATURES + 1:]))])
    return OrdinalModel(theta[:FEATURES] / scale, cuts, levels.astype(np.float64))


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``<id_col>, grade``: one rating per document, the lowest where a document has several;
    rows without id or quality have none (a null ``toxic`` counts as 0)."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 0, 2).otherwise(1)
    return (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).select(id_col, grade.alias("grade"))
            .groupBy(id_col).agg(F.min("grade").alias("grade")))


def rated_features(docs: DataFrame, ratings: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``grade, hash, indices, values`` of every rated document, stored: its sparse features and a
    hash of its id."""
    from biblioflow.session import scratch_path

    texts = docs.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # one plan at every size: ratings grow with the documents, so they are never broadcast
    rated = texts.join(ratings.hint("merge"), id_col).select("grade", F.xxhash64(F.col(f"`{id_col}`"), F.lit(17)).alias("hash"), "text")
    path = scratch_path(docs.sparkSession, "rated")
    rated.mapInArrow(feature_rows, "grade int, hash long, indices binary, values binary").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema("grade int, hash long, indices binary, values binary").parquet(path)


def fit_parts(rows: DataFrame, max_rated: int) -> OrdinalModel | None:
    """The model of all ``rows`` of ``rated_features``: parts of about ``max_rated`` of them are
    fitted each by a task, and their weights and thresholds averaged, by the parts' rows."""
    counts = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}  # three grades
    levels = np.array(sorted(counts))
    if len(levels) < 2:
        return None
    parts = max(1, -(-sum(counts.values()) // max_rated))

    def fit(part: pa.Table) -> pa.Table:
        got = sorted(zip(*[part.column(c).to_pylist() for c in ("grade", "indices", "values")]))  # the same order however they came
        one = fit_ordinal(np.array([g for g, _, _ in got]), [(np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4")) for _, i, v in got], levels)
        value = np.concatenate([one.weights, one.thresholds])
        n = len(value)
        return pa.table({"part": pa.array([part.column("part")[0].as_py()] * n, pa.int32()), "index": pa.array(np.arange(n, dtype="int32")),
                         "n": pa.array([len(got)] * n, pa.int64()), "value": pa.array(value)})

    fits = rows.withColumn("part", F.pmod("hash", F.lit(parts)).cast("int")).groupBy("part").applyInArrow(fit, "part int, index int, n long, value double")
    each = fits.groupBy("index").agg(F.array_sort(F.collect_list(F.struct("part", "n", "value"))).alias("fits"))  # summed in one order
    mean = F.aggregate("fits", F.lit(0.0), lambda a, x: a + x["n"] * x["value"]) / F.aggregate("fits", F.lit(0.0), lambda a, x: a + x["n"])
    value = np.zeros(FEATURES + len(levels) - 1)
    for r in each.select("index", mean.alias("value")).collect():  # FEATURES numbers, however many the rows
        value[r["index"]] = r["value"]
    return OrdinalModel(value[:FEATURES], value[FEATURES:], levels.astype(np.float64))


def fit_quality(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                max_rated: int = MAX_RATED) -> OrdinalModel | None:
    """The model of all rated documents."""
    return fit_parts(rated_features(docs, ratings, id_col, text_col), max_rated)


@dataclass
class Selection:
    """Which documents stay: those with P(grade >= min_grade) >= min_tail.  The shares are
    those of the held-out documents (None where there were none)."""

    min_grade: float
    min_tail: float
    clean_kept: float | None
    lower_dropped: dict


def fit_selection(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  max_rated: int = MAX_RATED, min_grade: float = 2, clean_kept: float = CLEAN_KEPT) -> tuple[OrdinalModel | None, Selection]:
    """A model, and a threshold of P(grade >= min_grade) from rated documents that it was not
    fitted on (a fifth of all, by a hash of their ids): of the thresholds that keep a share of
    ``clean_kept`` of the documents of that grade, the one that tells most of the lower ones
    apart.  Without held-out documents of both kinds the threshold is 0.5."""
    rows = rated_features(docs, ratings, id_col, text_col)
    held = F.pmod(F.xxhash64("hash"), F.lit(5)) == 0
    model = fit_parts(rows.where(~held), max_rated)
    if model is None:
        return model, Selection(min_grade, 0.5, None, {})
    min_grade = float(model.grades[min(int(np.searchsorted(model.grades, min_grade)), len(model.grades) - 1)])  # the best there is
    if min_grade == model.grades[0]:
        return model, Selection(min_grade, 0.5, None, {})
    tails = held_tails(rows.where(held), model, min_grade)
    at, kept = best_threshold(tails, min_grade, clean_kept)
    if at is None:
        return model, Selection(min_grade, 0.5, None, {})
    dropped = tails.where(F.col("grade") < min_grade).groupBy("grade").agg(F.avg((F.col("tail") < at).cast("int")).alias("share")).collect()
    return model, Selection(min_grade, at, kept, {r["grade"]: r["share"] for r in dropped})


def held_tails(rows: DataFrame, model: OrdinalModel, min_grade: float) -> DataFrame:
    """``grade, tail`` of held-out documents, stored."""
    from biblioflow.session import scratch_path

    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model.weights)  # FEATURES numbers
    cut = float(model.thresholds[int(np.searchsorted(model.grades, min_grade)) - 1])

    def run(batches):
        w = shared.value
        for batch in batches:
            score = np.array([float(np.frombuffer(v, "<f4") @ w[np.frombuffer(i, "<i4")])
                              for i, v in zip(batch.column("indices").to_pylist(), batch.column("values").to_pylist())], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(1 / (1 + np.exp(np.clip(cut - score, -700, 700))))], ["grade", "tail"])

    path = scratch_path(spark, "held-tails")
    rows.select("grade", "indices", "values").mapInArrow(run, "grade int, tail double").write.parquet(path)
    return spark.read.schema("grade int, tail double").parquet(path)


def best_threshold(tails: DataFrame, min_grade: float, clean_kept: float) -> tuple[float | None, float | None]:
    """The threshold and the share of clean documents it keeps, by exact counts of all rows below
    each clean document's tail (None without documents of both kinds)."""
    clean = F.col("grade") >= min_grade
    total = tails.agg(F.count_if(clean).alias("clean"), F.count_if(~clean).alias("lower"),
                      F.percentile_approx("tail", [i / RANGES for i in range(1, RANGES)], 10_000).alias("cuts")).first()
    if not total["clean"] or not total["lower"]:
        return None, None
    # counts below = those of lower ranges, cumulated over the small frame, and those below within the range
    ranged = F.size(F.filter(F.lit([float(c) for c in total["cuts"]]), lambda c: c < F.col("tail")))
    each = tails.groupBy(ranged.alias("range"), "tail").agg(F.count_if(clean).alias("clean"), F.count_if(~clean).alias("lower"))
    up = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = each.groupBy("range").agg(F.sum("clean").alias("clean"), F.sum("lower").alias("lower")).select(
        "range", *[F.coalesce(F.sum(c).over(up), F.lit(0)).alias(f"{c}_ranges") for c in ("clean", "lower")])
    inside = Window.partitionBy("range").orderBy("tail").rowsBetween(Window.unboundedPreceding, -1)
    below = each.join(F.broadcast(ranges), "range").select("tail", "clean", *[  # RANGES rows
        (F.col(f"{c}_ranges") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_below") for c in ("clean", "lower")])
    gain = F.col("lower_below") / total["lower"] - F.col("clean_below") / total["clean"]
    best = (below.where((F.col("clean") > 0) & (F.col("clean_below") <= int((1 - clean_kept) * total["clean"])))
            .orderBy(gain.desc(), "tail").first())
    return float(best["tail"]), 1 - best["clean_below"] / total["clean"]


def text_scores(col: pa.Array, model: OrdinalModel) -> np.ndarray:
    """Score of each text; a text without words scores 0."""
    data, off = buffers(col)
    start, end, first = word_spans(data, off)
    if len(start) == 0:
        return np.zeros(len(col))
    word, shape, again = word_features(data, start, end, first)
    value = np.where(again, model.weights[FEATURES - 1], model.weights[word] + model.weights[shape])
    return _per_text(value, first) / np.maximum(np.diff(first), 1)


def rate_quality(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text", *,
                 min_grade: float = 1, min_tail: float = 0.5) -> DataFrame:
    """One row per input row: ``<id_col>, expected_grade, tail, kept``.

    ``tail`` is P(grade >= min_grade); a row is kept if that is at least ``min_tail``.  Null
    and empty texts score 0, which the thresholds alone decide.  Without a model (fewer than
    two grades among the ratings) both figures are null and every row is kept.  Repeated
    rows stay; a text is scored whole, however long; other columns aren't read."""
    return _rated(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")), model, "_text", min_grade, min_tail).select(
        F.col("_row._id").alias(id_col), "expected_grade", "tail", "kept")


def keep_quality(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text", *, min_grade: float = 1, min_tail: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``rate_quality`` keeps, all columns."""
    return _rated(docs, model, text_col, min_grade, min_tail).where("kept").select("_row.*")


def _rated(docs: DataFrame, model: OrdinalModel | None, text_col: str, min_grade: float, min_tail: float) -> DataFrame:
    """``_row`` (all columns of ``docs``, its text among them, once), ``expected_grade, tail, kept``."""
    rows = docs.select(F.struct("*").alias("_row"))
    if model is None:
        return rows.select("_row", F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail"), F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds, model.grades))  # FEATURES numbers
    at = docs.columns.index(text_col)

    def run(batches):
        release()
        m = OrdinalModel(*shared.value)
        asked = int(np.searchsorted(m.grades, min_grade))  # the first grade that is high enough
        for batch in batches:
            row = batch.column("_row")
            both = pa.RecordBatch.from_arrays([row, row.field(at).cast(pa.large_string())], ["_row", "text"])
            for part, col in pieces(both, "text"):
                score = text_scores(col, m)
                tail = 1 / (1 + np.exp(np.clip(m.thresholds[None, :] - score[:, None], -700, 700)))
                expected = m.grades[0] + tail @ np.diff(m.grades)
                want = np.ones(len(score)) if asked == 0 else tail[:, asked - 1] if asked <= tail.shape[1] else np.zeros(len(score))
                yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(expected), pa.array(want), pa.array(want >= min_tail)],
                                                 ["_row", "expected_grade", "tail", "kept"])

    shape = T.StructType([rows.schema["_row"], T.StructField("expected_grade", T.DoubleType()),
                          T.StructField("tail", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    return rows.mapInArrow(run, shape)


ship_by_value(__name__)
