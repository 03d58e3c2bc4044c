"""Components of few edges take few tasks, and are right however many tasks there are."""
import random

from biblioflow.llm import components as c


def _expected(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def _edges():
    r = random.Random(5)
    return [(i, i + 1) for i in range(100, 130)] + [(500, 500 + r.randrange(1, 400)) for _ in range(300)] + [(i, i + 5000) for i in range(1000, 1100)]


def test_few_edges_are_written_by_few_tasks(spark, monkeypatch):
    files = []
    kept = c._written

    def written(df, name):
        out = kept(df, name)
        files.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(c, "_written", written)
    set_before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = _edges()
        found = c.components(spark.createDataFrame(edges, "a long, b long"))
        assert {r["node"]: r["component"] for r in found.collect()} == _expected(edges)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", set_before)
    assert len(files) > 3 and all(n == 1 for _, n in files[1:])  # the first holds edges of unknown number


def test_many_edges_are_dealt_as_before(spark, monkeypatch):
    monkeypatch.setattr(c, "EDGES_A_TASK", 10)
    edges = _edges()
    found = c.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == _expected(edges)
