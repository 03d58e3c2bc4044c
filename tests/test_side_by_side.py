import threading

import pytest
from conftest import SF_SMALL

from biblioflow.operators import modeling as L
from biblioflow.plans import fixtures as X


def test_fits_run_at_once_and_keep_their_order(spark):
    met = threading.Barrier(3)

    def fit(i):
        met.wait(60)  # none goes on before all have begun
        return spark.range(i).count()

    assert L.side_by_side(spark, fit, [5, 3, 4]) == [5, 3, 4]


def test_a_failed_fit_fails_the_whole(spark):
    with pytest.raises(ZeroDivisionError):
        L.side_by_side(spark, lambda i: 1 / i, [1, 0])


def test_leaderboard_tokenises_once_and_scores_as_single_fits(spark, monkeypatch):
    df = L.training_frame(spark, X.model_frame(spark, SF_SMALL))
    train, valid = df.where("split = 'train'"), df.where("split = 'validation'")
    seen, hashed = [], L.hashed_texts
    monkeypatch.setattr(L, "hashed_texts", lambda *a, **k: seen.append(1) or hashed(*a, **k))
    models = {"small": L.random_forest(trees=2, max_depth=2), "plain": L.logistic()}
    got = {r.model: r for r in L.leaderboard(train, valid, models, 64).collect()}
    assert len(seen) == 2 and sorted(got) == ["plain", "small"]  # training and validation rows, for all models
    scored = L.score(L.fit_model(train, L.logistic(), 64), valid)
    assert got["plain"].accuracy == pytest.approx(scored.where("prediction = label").count() / valid.count())
