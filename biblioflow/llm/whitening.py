"""Embedding whitening: exact distributed covariance, eigenvectors by mixed-precision refinement.

* Entries are put on an integer grid, x = floor(scale * c) + shift, so that sums and centred
  products are whole numbers: tasks add them exactly (float64 matrix products while a block's
  sums stay below 2^53, Python integers beyond), Spark adds the tasks' parts as decimals, and
  the covariance doesn't depend on partitions or order.  Products are taken of x minus the
  rounded mean; what the rounding leaves is taken off exactly.
* The d x d covariance (d: length of a vector, the only thing that reaches the driver) is
  solved in float32, and those eigenvectors are refined by Ogita and Aishima's iteration,
  matrix products in extended precision only.  Eigenvalues too close for it are clusters:
  the covariance, shifted by a cluster's mean and restricted to its subspace, is solved anew.
* Rows are projected where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.words import ship_by_value
from biblioflow.session import scratch_path

SCALE, SHIFT = 1024.0, 100_000
LONG = 2 ** 63


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening; x - mean is ``x - centre - rest / n``."""

    n: int
    scale: float
    shift: int
    centre: list[int]  # means rounded to whole numbers
    rest: list[int]  # sums minus n times centre
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one per column
    trace: float


def _off_diagonal(m: np.ndarray) -> float:
    return float(np.abs(m - np.diag(np.diag(m))).max()) if len(m) else 0.0


def refine_eigenvectors(a: np.ndarray, x: np.ndarray, limit: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the symmetric ``a``, falling, from
    approximate eigenvectors ``x``; all in ``a``'s precision.

    A step adds x @ e, where e solves the first-order conditions of orthonormality (its
    symmetric part) and of a diagonal x' a x (its antisymmetric part, so that rounding over a
    small gap turns vectors and doesn't skew them); errors are squared from step to step.
    Where two eigenvalues are closer than the step's own uncertainty, e takes care of
    orthonormality only, and the cluster is solved on its subspace, shifted by its mean so
    that float64 sees the differences."""
    d = len(a)
    kind = a.dtype.type
    size = kind(np.abs(a).max()) if d else kind(1)
    if not d or size == 0:
        return np.zeros(d, kind), np.eye(d, dtype=kind)
    a, x = a / size, x.astype(kind)
    norm = float(np.linalg.norm(a.astype(np.float64), 2))
    tol = 16 * float(np.finfo(kind).eps) * d
    one = np.eye(d, dtype=kind)
    for _ in range(limit):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        lam = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-lam, kind="stable")
        x, lam, r, s = x[:, order], lam[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        spread = np.linalg.norm((s - np.diag(lam)).astype(np.float64), 2) + norm * np.linalg.norm(r.astype(np.float64), 2)
        gap = lam[None, :] - lam[:, None]
        apart = np.abs(gap) > max(2 * spread, tol * norm)
        turn = (s + s.T) / 2 + (lam[None, :] + lam[:, None]) / 2 * r
        x = x + x @ (r / 2 + np.where(apart, turn / np.where(apart, gap, 1), 0))
        done = np.abs(np.where(apart, turn, 0)).max() <= tol * norm
        edges = np.flatnonzero(np.append(np.append(True, np.diag(apart, 1)), True))
        for first, last in zip(edges[:-1], edges[1:]):
            if last - first < 2:
                continue
            v = x[:, first:last]
            inner = v.T @ (a @ v - v * lam[first:last].mean())
            if _off_diagonal(inner) > tol * norm:
                x[:, first:last] = v @ np.linalg.eigh(((inner + inner.T) / 2).astype(np.float64))[1][:, ::-1].astype(kind)
                done = False
        if done:
            break
    for _ in range(3):  # what turning over small gaps, or a cluster's float64 solution, left
        x = x + x @ ((one - x.T @ x) / 2)
    lam = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-lam, kind="stable")
    return lam[order] * size, x[:, order]


def covariance(n: int, rest: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """(products - rest rest' / n) / n, rounded once, in extended precision."""
    d = len(rest)
    out = np.zeros((d, d), np.longdouble)
    for (i, j), g in products.items():
        out[i, j] = out[j, i] = np.longdouble(n * g - rest[i] * rest[j]) / np.longdouble(n) / np.longdouble(n)
    return out


def solve(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of ``cov``: float32, then refined; each
    vector's largest entry is positive."""
    top = np.abs(cov).max() if cov.size else 0
    start = np.linalg.eigh((cov / top).astype(np.float32))[1] if top > 0 else np.eye(len(cov))
    values, vectors = refine_eigenvectors(cov, start)
    lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(cov))] if len(cov) else np.zeros(0)
    return values, vectors * np.where(lead < 0, -1, 1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``_id, _c`` (array of doubles) of the rows that take part."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("_c"))
    fits = F.forall("_c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(2.0 ** 50)))
    rows = rows.where(F.col("_c").isNotNull()).where(fits)
    length = rows.groupBy(F.size("_c").alias("n")).agg(F.count(F.lit(1)).alias("c")).agg(F.max_by("n", F.struct("c", "n"))).scalar()
    return rows.where(F.size("_c") == length)


def grid(batch: pa.RecordBatch, scale: float, shift: int) -> np.ndarray:
    """x of a batch's vectors, as int64."""
    flat = np.asarray(batch.column("_c").flatten(), np.float64)
    return (np.floor(flat * scale).astype(np.int64) + shift).reshape(batch.num_rows, -1)


def _exact(parts: Iterator[tuple[np.ndarray, float]]) -> np.ndarray:
    """Sum of (whole numbers, bound on their size), as Python integers."""
    total, run, held = None, None, 0.0
    for part, bound in parts:
        if part.dtype == object or held + bound >= 2.0 ** 62:
            if run is not None:
                total = run.astype(object) if total is None else total + run
                run, held = None, 0.0
            if part.dtype == object:
                total = part if total is None else total + part
                continue
        run, held = part.astype(np.int64) if run is None else run + part.astype(np.int64), held + bound
    if run is not None:
        total = run.astype(object) if total is None else total + run
    return total


def products(y: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Parts of y' y: float64 products of as many rows as stay exact, Python integers for rows
    whose squares alone do not."""
    big = np.abs(y).max(axis=1) if y.size else np.zeros(0, np.int64)
    order = np.argsort(big, kind="stable")
    at = 0
    while at < len(order):
        # rows by size: the block's last row bounds all of it
        fits = (np.arange(1, len(order) - at + 1) * np.square(big[order[at:]].astype(np.float64))) < 2.0 ** 52
        many = int(fits.sum()) if fits[0] else 0
        if many:
            block = y[order[at:at + many]].astype(np.float64)
            yield block.T @ block, 2.0 ** 52
        else:
            many = 1
            row = y[order[at]].astype(object)
            yield np.outer(row, row), float("inf")
        at += many


def fit_whitening(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, scale: float = SCALE,
                  shift: int = SHIFT) -> Whitening | None:
    """The whitening of all rows that take part (``usable``); None if there are none."""
    rows = usable(vectors, id_col, vector_col).select("_c")

    def sums(batches):
        n, parts = 0, []

        def every():
            nonlocal n
            for batch in batches:
                x = grid(batch, scale, shift)
                if len(x):
                    n += len(x)
                    bound = float(np.abs(x).max(initial=0)) * len(x)
                    yield (x.sum(axis=0) if bound < 2.0 ** 62 else x.astype(object).sum(axis=0)), bound
        total = _exact(every())
        parts = [n, *([] if total is None else total)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(parts) - 1), pa.int32()), pa.array([Decimal(int(v)) for v in parts], pa.decimal128(38, 0))], ["i", "v"])

    found = {r["i"]: int(r["v"]) for r in rows.mapInArrow(sums, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()}  # d + 1 rows
    if not found:
        return None
    n, total = found[-1], [found[i] for i in range(len(found) - 1)]
    centre = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * m for s, m in zip(total, centre)]
    d = len(total)

    def gram(batches):
        middle = np.array(centre, np.int64)
        total = _exact(p for batch in batches if batch.num_rows for p in products(grid(batch, scale, shift) - middle))
        if total is not None and d:
            i, j = np.triu_indices(d)
            for a in range(0, len(i), 1 << 16):
                cut = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(i[cut].astype(np.int32)), pa.array(j[cut].astype(np.int32)),
                                                  pa.array([Decimal(int(v)) for v in total[i[cut], j[cut]]], pa.decimal128(38, 0))], ["i", "j", "v"])

    pairs = rows.mapInArrow(gram, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    cov = covariance(n, rest, {(r["i"], r["j"]): int(r["v"]) for r in pairs.collect()})  # d (d + 1) / 2 rows
    values, basis = solve(cov)
    return Whitening(n, scale, shift, centre, rest, values.astype(np.float64), basis.astype(np.float64), float(np.trace(cov)))


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", *,
           scale: float = SCALE, shift: int = SHIFT) -> DataFrame:
    """``<id_col>, component, n, deviation, whitened, explained, identity_error`` for each row
    that takes part and each of the first ``components`` components.

    Rows whose vector is null or holds null, non-finite or over-large entries (from 2^50)
    take no part, nor do vectors that are not of the most frequent length (the larger of
    equals).  Every row that takes part is fitted and returned, rows with null or repeated ids
    too.  Eigenvalues that are 0 to double precision have no whitening; their components are
    left out, so equal vectors, or a single one, give no rows.  Among equal eigenvalues any
    orthonormal eigenvectors are right.  ``deviation`` is the exact sum of (n x - S)^2, null
    where it exceeds a long.  ``identity_error`` compares the returned values' own covariance
    with the identity.  An empty table gives an empty result; other columns aren't read."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    fitted = fit_whitening(vectors, id_col, vector_col, scale=scale, shift=shift)
    k = 0
    if fitted is not None and len(fitted.values):
        floor = len(fitted.values) * np.finfo(np.float64).eps * fitted.values[0]
        k = min(components, int((fitted.values > floor).sum()))
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return spark.createDataFrame([], schema)
    model = spark.sparkContext.broadcast(fitted)  # d * d numbers

    def project(batches):
        w = model.value
        n, centre = w.n, np.array(w.centre, np.int64)
        axes = w.vectors[:, :k] / np.sqrt(w.values[:k])
        rest = np.array(w.rest, object)
        offset = np.array([float(r) for r in w.rest]) / n
        far = max(abs(r) for r in w.rest)
        for batch in batches:
            y = grid(batch, w.scale, w.shift) - centre
            if not len(y):
                continue
            widest = n * int(np.abs(y).max()) + far
            if widest * widest * len(centre) < LONG:
                gone = np.square(n * y - rest.astype(np.int64)).sum(axis=1).tolist()
            else:
                gone = [v if v < LONG else None for v in np.square(n * y.astype(object) - rest).sum(axis=1)]
            out = (y - offset) @ axes
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(gone, pa.int64()),
                                              pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), k).cast(pa.list_(pa.float64()))], ["_id", "deviation", "w"])

    path = scratch_path(spark, "whitened")
    usable(vectors, id_col, vector_col).mapInArrow(project, f"_id {kind}, deviation long, w array<double>").write.parquet(path)
    rows = spark.read.parquet(path)
    at = lambda i: F.col("w")[i]
    errors = [F.abs(F.covar_pop(at(i), at(j)) - (1.0 if i == j else 0.0)) for i in range(k) for j in range(i, k)]
    error = rows.agg((F.greatest(*errors) if len(errors) > 1 else errors[0]).alias("e"))
    share = F.element_at(F.array(*[F.lit(float(v) / fitted.trace) for v in fitted.values[:k]]), F.col("component"))
    return rows.select("_id", "deviation", F.posexplode("w").alias("_at", "whitened")).withColumn("component", F.col("_at") + 1).select(
        F.col("_id").alias(id_col), "component", F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), error.scalar().alias("identity_error"))


ship_by_value(__name__)
