"""What the feeds' queries write, shuffle and hold grows with the tables, not with rendered texts."""

import os

from pyspark.sql import functions as F

from biblioflow.operators import joins as E
from biblioflow.plans import catalog as K
from biblioflow.plans import fixtures as X
from biblioflow.session import scratch_path
from conftest import SF_SMALL, rows


def _tables(spark, path, orders):
    spark.createDataFrame([(k, 7, "F", "1-URGENT", "1996-01-02") for k in orders],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate string").write.parquet(f"{path}/orders.parquet")
    lines = [(1, 2, 30), (1, 1, 9), (1, 1, 10), (None, 1, 5), (1, 3, None), (None, 2, 6)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long").write.parquet(f"{path}/lineitem.parquet")
    return path


def test_people_in_order_with_nulls_and_repeats(spark, tmp_path):
    sf = _tables(spark, str(tmp_path), [1, 1, 2, None])
    got = [(r.paper_id, None if r.people is None else [(p.seq, p.auid, p.affid) for p in r.people]) for r in X.papers_with_people(spark, sf).collect()]
    people = [(1, "A10", "F10"), (1, "A9", "F9"), (2, "A30", "F5"), (3, None, None)]
    assert sorted(got, key=str) == sorted([(1, people), (1, people), (2, None), (None, None)], key=str)


def test_feed_joins_move_no_rendered_texts(spark):
    for build in (X.nested_paper_json, X.search_paper_json):
        plan = build(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Join LeftOuter"):]
        assert "to_json" not in below and "Conference Proceeding" not in below


def test_papers_meet_people_in_parts_of_bounded_rows(spark, tmp_path, monkeypatch):
    sf = _tables(spark, str(tmp_path), list(range(90)))
    cores = spark.sparkContext.defaultParallelism
    assert X.papers_with_people(spark, sf).rdd.getNumPartitions() == cores
    monkeypatch.setattr(X, "PEOPLE_ROWS", 5)
    people = X.papers_with_people(spark, sf)
    assert people.rdd.getNumPartitions() == 18 and people.count() == 90
    # lines are dealt before they are grouped: no group is held on the side that writes the shuffle
    plan = people._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.rindex("RepartitionByExpression")


def test_landed_feeds_are_compressed(spark):
    path = K.landed_feed(spark, SF_SMALL, "nested-papers")
    text = spark.read.text(path)
    on_disk = sum(os.path.getsize(f.removeprefix("file://")) for f in text.inputFiles())
    assert on_disk * 5 < text.agg(F.sum(F.length("value"))).first()[0]


def test_array_files_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(K, "ARRAY_PAPERS", 100)
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert K._array_count(spark, SF_SMALL) == -(-n // 100)
    files = K._array_files(spark.range(700).select(F.col("id").alias("paper_id"), F.lit("{}").alias("json")), 7)
    path = scratch_path(spark, "arrays")
    files.write.text(path)
    counts = [r["count"] for r in spark.read.text(path).where("value = '{},'").groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(counts) == 7 and max(counts) < 200


def test_folders_are_written_without_sorting(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).alias("year"), F.col("id").cast("string").alias("value"))
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 16
    df.write.partitionBy("year").text(str(tmp_path / "y"))
    assert spark.read.text(str(tmp_path / "y")).count() == 100


def test_largest_refcounts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, 9), ("b", None)], "DOI string, References int")
    once = E.largest_refcounts(df)
    assert rows(once) == [("a", 5), ("b", None)]
    assert rows(E.largest_refcounts(once)) == rows(once)


def test_stream_batches_do_not_grow_with_the_feed(spark, monkeypatch):
    monkeypatch.setattr(X, "FEED_CHUNK", 10)
    monkeypatch.setattr(K, "_LANDED", {})
    seen = []
    upsert = K.K.upsert_stream

    def counting(stream, transform, *args, **kw):
        def each(batch):
            seen.append(1)
            return transform(batch)
        return upsert(stream, each, *args, **kw)

    monkeypatch.setattr(K.K, "upsert_stream", counting)
    out = K.QUERIES["K2_microbatch_upsert"](spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey % 20 <> 7").count()
    assert out.count() == n and 1 <= len(seen) <= K.K2_BATCHES
