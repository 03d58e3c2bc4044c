"""The quality model and its threshold come from all rated documents."""

import numpy as np
from pyspark.sql import functions as F

from biblioflow.llm import quality
from test_search_archive import rated


def test_parts_cover_all_rated_documents(spark, monkeypatch):
    docs, labels = rated(spark)
    seen = spark.sparkContext.accumulator(0)
    fit = quality.fit_ordinal

    def counting(grades, rows, levels=None):
        seen.add(len(rows))
        return fit(grades, rows, levels)

    monkeypatch.setattr(quality, "fit_ordinal", counting)
    model, keep = quality.fit_selection(docs, quality.graded(labels), max_rated=60)
    held = quality.rated_features(docs, quality.graded(labels), "doc_id", "text").where(F.pmod(F.xxhash64("hash"), F.lit(5)) == 0).count()
    assert seen.value == 400 - held and 50 < held < 110  # 60 with a sample
    again, other = quality.fit_selection(docs.repartition(7), quality.graded(labels), max_rated=60)
    assert (again.weights == model.weights).all() and other == keep
    got = {r["doc_id"]: r["kept"] for r in quality.rate_quality(docs, model, min_grade=keep.min_grade, min_tail=keep.min_tail).collect()}
    grade = {r["doc_id"]: r["grade"] for r in quality.graded(labels).collect()}
    assert np.mean([got[i] == (grade[i] == 2) for i in grade]) > 0.9


def test_threshold_is_exact_over_all_held_documents(spark):
    rng = np.random.default_rng(3)
    grade = rng.integers(0, 3, 3000)
    tail = np.round(1 / (1 + np.exp(-(grade - 1.5 + rng.normal(0, 1, 3000)))), 3)
    df = spark.createDataFrame([(int(g), float(t)) for g, t in zip(grade, tail)], "grade int, tail double").repartition(5)
    at, kept = quality.best_threshold(df, 2, 0.9)
    clean, lower = np.sort(tail[grade == 2]), np.sort(tail[grade < 2])
    each = clean[:int((1 - 0.9) * len(clean)) + 1]
    gain = np.searchsorted(lower, each) / len(lower) - np.searchsorted(clean, each) / len(clean)
    assert at == each[np.argmax(gain)] and abs(kept - (clean >= at).mean()) < 1e-12
    assert quality.best_threshold(df.where("grade = 2"), 2, 0.9) == (None, None)
