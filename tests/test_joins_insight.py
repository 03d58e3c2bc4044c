import pytest
from pyspark.sql import functions as F

from biblioflow.operators import insight as FI
from biblioflow.operators import joins as E
from biblioflow.sources import sinks as B
from conftest import rows


def test_join_refcounts_dedupes_right_side(spark):
    papers = spark.createDataFrame([("d1",), ("d2",), (None,), ("d1",)], "`prism:doi` string")
    refs = spark.createDataFrame([("e", "d1", 3), ("e", "d1", 9), ("e", None, 5)], "EID string, DOI string, References int")
    out = E.join_refcounts(papers, refs)
    assert rows(out) == [("d1", 9), ("d1", 9), ("d2", 0), (None, 0)]


def test_enrich_by_key_keeps_old_when_new_missing(spark):
    base = spark.createDataFrame([("d1", "old", "s1"), ("d2", "old2", "s2")], "doi string, author string, source_id string")
    upd = spark.createDataFrame([("d1", None, "s9", 1), ("d3", "x", "y", 1)], "doi string, author string, source_id string, seq int")
    out = E.enrich_by_key(base, upd, "doi", ["author", "source_id"], order=["seq"])
    assert rows(out) == [("d1", "old", "s9", True), ("d2", "old2", "s2", False)]
    st = FI.retrieval_stats(out).first()
    assert (st.total, st.success, st.failed, st.success_pct) == (2, 1, 1, 50.0)


def test_enrich_affiliations_overwrites_with_nulls(spark):
    ids = spark.createDataFrame([("F1", "keep"), ("F2", "keep")], "`@affid` string, preferredName string")
    prof = spark.createDataFrame([("F1", None, ["v"], None, None, None, None)],
                                 "`@affid` string, preferredName string, nameVariants array<string>, "
                                 "metrics struct<documentsCount:int,authorsCount:int>, address struct<country:string>, "
                                 "hierarchyIds array<string>, contact string")
    out = {r["@affid"]: r for r in E.enrich_affiliations(ids, prof).collect()}
    assert out["F1"].preferredName is None and out["F1"].nameVariants == ["v"]
    assert out["F1"].metrics is not None and out["F1"].metrics.documentsCount is None  # {} not NULL
    assert out["F2"].preferredName == "keep" and out["F2"].metrics is None


def test_new_papers_keeps_duplicates(spark):
    p = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "doi string")
    k = spark.createDataFrame([("b",)], "doi string")
    assert rows(E.new_papers(p, k)) == [("a",), ("a",)]


def test_upsert_replaces_keys_deterministically_with_hot_key(spark):
    existing = spark.createDataFrame([("k1", 0, "old"), ("k2", 0, "old")], "k string, v int, p string")
    hot = [("k1", i, f"p{i}") for i in range(3000)]  # one key holding most of the incoming rows
    incoming = spark.createDataFrame(hot + [("k3", 1, "new"), (None, 5, "nokey")], "k string, v int, p string")
    out = B.upsert(existing, incoming, "k", ["v"])
    assert rows(out) == [("k1", 2999, "p2999"), ("k2", 0, "old"), ("k3", 1, "new")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # reduced by a partial hash aggregate, not a per-key sort


def test_latest_per_key_tie_is_deterministic(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b")], "k string, o int, x string")
    a = E.latest_per_key(df, "k", ["o"]).first().x
    b = E.latest_per_key(df.orderBy(F.desc("x")), "k", ["o"]).first().x
    assert a == b


def test_value_counts_order_and_top(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "s string")
    assert [tuple(r) for r in FI.value_counts(df, "s").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert [tuple(r) for r in FI.top_values(df, "s", 1).collect()] == [("a", 2)]


def test_histogram_edges_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "ref_count double")
    h = {r.bin: r.n for r in FI.histogram(df, "ref_count", 5).collect()}
    assert h == {0: 2, 1: 0, 2: 0, 3: 0, 4: 1}  # max value lands in the last (closed) bin
    const = spark.createDataFrame([(3.0,), (3.0,)], "ref_count double")
    assert {r.bin: r.n for r in FI.histogram(const, "ref_count", 2).collect()} == {0: 2, 1: 0}


def test_quota_applies_exact_per_group_limit(spark):
    df = spark.createDataFrame([(i, f"d{i}" if i % 5 else None, 2013, i % 2) for i in range(40)],
                               "paper_id int, doi string, year int, category int")
    out = FI.apply_quota(df, {2013: (3, 4)}, order=["paper_id"])
    got = rows(out.groupBy("category").count())
    assert got == [(0, 3), (1, 4)]
    assert rows(out.where("category = 0"), "paper_id") == [(2,), (4,), (6,)]


def test_coverage_matrix_and_graph(spark):
    df = spark.createDataFrame([(2013, 0), (2013, 3), (2014, 1)], "year int, category int")
    assert rows(FI.coverage_matrix(df)) == [(2013, 1, 0, 0, 1), (2014, 0, 1, 0, 0)]
    g = spark.createDataFrame([("S1", "Article"), ("S1", "Article"), ("S2", None)], "main_subject_area string, document_type string")
    nodes, edges = FI.subject_doctype_graph(g)
    assert rows(edges) == [("S1", "Article", 2)]
    assert rows(nodes) == [("Article", "document_type"), ("S1", "subject")]


def test_bucket_upsert_writes_only_touched_buckets(spark, tmp_path):
    import os

    path = str(tmp_path / "keyed")
    first = spark.createDataFrame([(f"k{i}", 0, "old") for i in range(200)], "k string, v int, p string")
    B.upsert_buckets(spark, path, first, "k", ["v"], version=0, buckets=8)
    written = lambda v: {int(d.split("=")[1]) for d in os.listdir(f"{path}/table_version={v:08d}") if d.startswith("bucket_of_8=")}
    assert written(0) == set(range(8))
    inc = spark.createDataFrame([("k7", 5, "new"), ("k7", 1, "older"), ("new", 1, "n"), (None, 9, "no key")], "k string, v int, p string")
    touched = {r[0] for r in inc.where("k IS NOT NULL").select(B.bucket_of(["k"], 8)).collect()}
    B.upsert_buckets(spark, path, inc, "k", ["v"], version=1, buckets=8)
    assert written(1) == touched
    out = B.read_keyed_table(spark, path)
    got = dict(rows(out, "k", "p"))
    assert got["k7"] == "new" and got["new"] == "n" and got["k8"] == "old" and out.count() == 201 and out.columns == ["k", "v", "p"]
    expected = rows(out)
    B.upsert_buckets(spark, path, inc, "k", ["v"], version=1, buckets=8)  # the same batch again
    B.upsert_buckets(spark, path, inc.limit(0), "k", ["v"], version=2, buckets=8)  # and one without rows
    assert rows(B.read_keyed_table(spark, path)) == expected
    plan = B.read_keyed_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket_of_8" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        B.upsert_buckets(spark, path, inc, "k", ["v"], version=3, buckets=16)
    small = str(tmp_path / "small")  # how a table gets other buckets, and loses old versions
    B.upsert_buckets(spark, small, B.read_keyed_table(spark, path), "k", ["v"], version=0, buckets=16)
    assert rows(B.read_keyed_table(spark, small)) == expected


def test_bucket_upsert_keeps_the_newest_of_late_deliveries(spark, tmp_path):
    path = str(tmp_path / "late")
    for n, v in enumerate((10, 5, 7)):
        B.upsert_buckets(spark, path, spark.createDataFrame([(1, v)], "k int, v int"), "k", ["v"], version=n, buckets=2)
    assert rows(B.read_keyed_table(spark, path)) == [(1, 10)]
    base = str(tmp_path / "versions")
    for n, v in enumerate((10, 5)):
        B.upsert_version(spark, base, spark.createDataFrame([(1, v), (None, 3)], "k int, v int"), "k", ["v"], n)
    assert rows(spark.read.parquet(f"{base}/table_version=00000001")) == [(1, 10)]


def test_bucket_upsert_runs_a_failed_batch_again(spark, tmp_path):
    """What a failed run left in its own version is overwritten and never merged."""
    path = str(tmp_path / "failed")
    frame = lambda n, v: spark.createDataFrame([(i, v) for i in range(n)], "k int, v int")
    B.upsert_buckets(spark, path, frame(20, 1), "k", ["v"], version=0, buckets=2)
    half = frame(20, 9).withColumn("bucket_of_2", B.bucket_of(["k"], 2)).where("bucket_of_2 = 0")
    half.write.partitionBy("bucket_of_2").parquet(f"{path}/table_version=00000001")
    B.upsert_buckets(spark, path, frame(20, 2), "k", ["v"], version=1, buckets=2)
    assert sorted(tuple(r) for r in B.read_keyed_table(spark, path).collect()) == [(i, 2) for i in range(20)]
