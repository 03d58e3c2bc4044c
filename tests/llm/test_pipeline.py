"""The registered queries and the pipeline on the smallest tables."""
import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL  # noqa: F401

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from biblioflow.llm import queries  # noqa: E402
from biblioflow.llm.ngram_join import jaccard_components  # noqa: E402
from biblioflow.llm.paragraph_dedup import repeated_paragraphs  # noqa: E402
from oracle_check import digest  # noqa: E402


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE) <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(queries.ORACLE[name])
    cols, want = [d[0] for d in res.description], res.fetchall()
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(cols) and digest(df.columns, got) == digest(cols, want)


def test_stages_work_on_what_their_predecessors_kept(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{spark.sparkContext.getCheckpointDir()}/stage-{name}"
        stage(spark, docs, SF_SMALL).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before)
        if name == "exact_copies":
            assert len(set(after.values())) == len(after) and set(after.values()) == set(before.values())
        if name == "near_copies":
            assert jaccard_components(docs).where("component_id <> doc_id").count() == 0
        if name == "passages":
            assert set(after) == set(before) and repeated_paragraphs(docs).count() == 0
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        elif name != "quality":
            assert all(after[i] == before[i] for i in after)
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r["doc_id"] for r in last.collect()} == set(before)


def test_pipeline_runs(spark):
    df = entry.queries()["pipeline"](spark, SF_SMALL)
    assert df.count() > 0 and df.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_stages_on_empty_and_odd_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = docs.limit(3).unionByName(spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "a", None, None, 1),
                                                       (9003, "word " * 40, None, "s", 200), (9003, "other\n" * 40, "en", None, 240), (9003, "word " * 40, None, "s", 200)], docs.schema))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
        assert stage(spark, odd, SF_SMALL).count() > 0
