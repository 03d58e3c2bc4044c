from pyspark.ml.linalg import Vectors

from biblioflow.operators import modeling as L


def test_fits_use_the_cores_there_are(spark):
    cores = spark.sparkContext.defaultParallelism
    assert L.training_parts(spark.range(0)) == L.training_parts(spark.range(500)) == 1
    assert L.training_parts(spark.range(1_001)) == min(3, cores)
    assert L.training_parts(spark.range(500 * cores * 3)) == cores
    assert L.training_parts(spark.range(50_000 * cores + 1)) == cores + 1


def test_boosting_rows_are_spread(spark, monkeypatch):
    stores = []
    stored = L.stored

    def counting(df, name):
        out = stored(df, name)
        stores.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(L, "stored", counting)
    rows = spark.createDataFrame(
        [(i, i % 5 == 0, float(i % 2), 1.0, Vectors.dense([float(i % 2), float(i % 7)])) for i in range(1_600)],
        ["doc_id", "is_validation", "label_d", "weight", "features"]).coalesce(1)
    model, losses = L.boost(rows, iters=2, patience=1, depth=2, min_leaf=1)
    assert len(losses) == 2 and stores[0] == min(spark.sparkContext.defaultParallelism, 4)
