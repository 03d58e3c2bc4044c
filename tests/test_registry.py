"""Registered queries vs their DuckDB oracles on sf0.001 (the driver's gate, locally)."""
import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as entry_mod  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

# model fits of half a minute and more: here with fewer rounds and trees
SLOW = ("L9_", "L10_", "L11_", "L16_", "L17_", "L18_")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "source_type", "is_full_conference", "n"]


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(n for n in entry_mod.oracle_sql() if not n.startswith(SLOW + ("op", "pipeline"))))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(exp)
    assert digest(df.columns, got) == digest(ocols, exp)


@pytest.mark.parametrize("name", sorted(n for n in entry_mod.oracle_sql() if n.startswith(SLOW)))
def test_long_fit_matches_oracle_in_a_session_with_observations(spark, con, name, monkeypatch):
    from functools import partial

    from biblioflow.operators import modeling as L
    from biblioflow.plans import catalog

    entry_mod.queries()["D4_validate_counts"](spark, SF_SMALL).collect()
    monkeypatch.setattr(L, "random_forest", partial(L.random_forest, trees=4, max_depth=5))
    monkeypatch.setattr(L, "gradient_boosting", partial(L.gradient_boosting, iters=3))
    monkeypatch.setattr(catalog, "ROUND_LIMIT", 12)
    monkeypatch.setattr(catalog, "PATIENCE", 4)
    test_query_matches_oracle(spark, con, name)
