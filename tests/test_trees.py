import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from biblioflow.operators import modeling as L
from biblioflow.operators import trees as G


def texts(spark, n=400, width=30, seed=3):
    """Sparse counts, some of them as dense vectors, and a number; labels by two features."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = sorted(rng.sample(range(width - 1), rng.randint(0, 6)))
        x = [0.0] * width
        for j in at:
            x[j] = float(rng.randint(1, 4))
        x[width - 1] = rng.gauss(0, 1)
        y = float((x[0] + x[1] + x[2] > 1) != (x[width - 1] > 1))
        v = Vectors.dense(x) if i % 3 == 0 else Vectors.sparse(width, [j for j in range(width) if x[j] != 0], [v for v in x if v != 0])
        rows.append((i, i % 4 == 0, y, 1.0 + i % 2, v))
    return spark.createDataFrame(rows, ["doc_id", "is_validation", "label_d", "weight", "features"])


def test_boosting_from_sparse_rows_takes_the_rounds_of_spark_fits(spark, monkeypatch):
    df = texts(spark)
    jobs = []
    monkeypatch.setattr(L, "boost_by_jobs", lambda *a: jobs.append(1))
    model, losses = L.boost(df, iters=12, patience=3, step=0.3, depth=3, min_leaf=5)
    assert not jobs  # no Spark fit a round
    monkeypatch.undo()
    _, others = L.boost_by_jobs(df, 2, 2, 3, 0.3, 3, 5, 42, "doc_id")
    assert losses[:2] == pytest.approx(others, rel=0.05) and min(losses) < losses[0]
    # Spark walks the saved trees as the task did
    held = df.where("is_validation").withColumn("label", F.col("label_d"))
    assert model.evaluateEachIteration(held) == pytest.approx(losses[:model.getNumTrees], abs=1e-9)
    assert all(t.depth <= 3 for t in model.trees)


def test_first_tree_is_that_of_spark(spark):
    df = texts(spark, width=12)
    model, _ = L.boost(df, iters=1, patience=1, step=1.0, depth=2, min_leaf=3)
    other, _ = L.boost_by_jobs(df, 1, 1, 1, 1.0, 2, 3, 42, "doc_id")
    a, b = model.trees[0], other.trees[0]
    assert a.numNodes == b.numNodes
    assert np.flatnonzero(a.featureImportances.toArray()).tolist() == np.flatnonzero(b.featureImportances.toArray()).tolist()


def test_forest_of_sparse_rows(spark, monkeypatch):
    df = texts(spark, 600)
    forest = L.random_forest(trees=12, max_depth=8)
    model = L.grown_forest(df, forest)
    assert model.getNumTrees == 12 and model.numClasses == 2 and model.numFeatures == 30
    out = model.transform(df).agg(F.avg((F.col("prediction") == F.col("label_d")).cast("int")), F.avg("prediction")).first()
    assert out[0] > 0.85
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9 and all(t.depth <= 8 for t in model.trees)
    lone = df.where("label_d = 0").limit(30).unionByName(df.where("label_d = 1").limit(1))
    one = L.grown_forest(lone, L.random_forest(trees=1).setBootstrap(False))
    assert one.transform(lone).where("prediction = label_d").count() < 31  # a single row can't be a leaf of its own


def test_more_than_a_task_holds_goes_to_spark(spark, monkeypatch):
    monkeypatch.setattr(G, "MOST_ENTRIES", {"forest": 10, "boosted": 10})
    df = texts(spark, 100)
    assert L.grown_forest(df, L.random_forest()) is None and L.grown_forest(df.limit(0), L.random_forest()) is None
    nan = df.limit(1).withColumn("features", F.lit(None).cast(df.schema["features"].dataType))
    assert L.grown_forest(nan, L.random_forest()) is None  # Spark's fit says what is wrong
    model, losses = L.boost(df, iters=2, patience=2, depth=1)
    assert len(losses) == 2


@pytest.mark.parametrize("n", [5, 200])
def test_bins_part_all_values(n):
    value = np.array([*np.linspace(-2, 3, n), np.nan])
    cuts = G.cuts_of(value, np.ones(len(value), np.int64), 4)
    assert len(cuts) == min(n + 1, G.MAX_BINS - 1) and (np.diff(cuts) > 0).all() and np.isfinite(cuts).all()
    layout = G.Layout(np.array([0, len(cuts) + 1]), cuts, np.array([np.searchsorted(cuts, 0.0)]))
    code = layout.codes(np.zeros(len(value), np.int32), value)
    assert code.tolist() == [*(int((cuts < v).sum()) for v in value[:-1]), len(cuts)]
