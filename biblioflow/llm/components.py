"""Connected components of an edge table, as Spark jobs (alternating large and small stars).

Each round replaces edges by stars around smaller ids; after a few rounds (about the square
of the logarithm of a component's diameter) every node points at its component's smallest
id.  A round is two aggregations and joins; its edges are written to the shared folder, so a
lost executor costs one round at most.  A hub's edges are pre-aggregated before they are
shuffled; the least neighbours are written before they are joined back, so that both sides
of that join are plain shuffles, whose skewed partitions Spark splits.  Few edges are written
by few tasks: a round has some ten shuffles, and each task of each leaves files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.session import scratch_path


#: Edges of a task, where there are fewer of them than for all cores.
EDGES_A_TASK = 1 << 17


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path  # for drop_written
    return out


def drop_written(*frames: DataFrame) -> None:
    """Remove the folders of frames from ``_written``.  Only for frames from which nothing is
    derived any more but what is written itself: a lost executor's work could not be done
    again."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark) -> None:
    """Have Spark remove the shuffle files of finished steps now: its cleaner follows the
    driver's garbage collection, which a driver with little to do puts off."""
    spark._jvm.System.gc()


def _dealt(df: DataFrame, edges: int) -> DataFrame:
    """``df`` in as many tasks as ``edges`` need; where that is one a core or more, as it is."""
    tasks = max(1, -(-edges // EDGES_A_TASK))
    return df.coalesce(tasks) if tasks < df.sparkSession.sparkContext.defaultParallelism else df


def _large_star(edges: DataFrame, n: int) -> tuple[DataFrame | None, DataFrame]:
    """(the star's edges, None if ``edges`` are stars apart already; the least neighbours it
    reads) of ``n`` edges.  They are such stars if every node that has a smaller neighbour has
    no other one: there are as many of these nodes, and neighbours of theirs, as edges."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _written(_dealt(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("degree")), n), "least")
    leaves = least.where("m < u").agg(F.count(F.lit(1)), F.sum("degree")).first()  # two numbers
    if leaves[0] == n and leaves[1] == n:
        return None, least
    moved = both.where("v > u").join(least.select("u", "m"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _dealt(_dealt(moved, n).distinct(), n), least


def _small_star(edges: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    least = _written(_dealt(edges.groupBy("u").agg(F.min("v").alias("m")), n), "least")  # every v is smaller than its u
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _dealt(_dealt(moved, n).unionByName(least.select("u", F.col("m").alias("v"))).distinct(), n), least


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``node, component`` (the smallest id reachable) for every node of edges ``a, b``
    (integers, any direction, repeats allowed).  Edges with a null end or from a node to
    itself join nothing and are left out, so a node that has only such is not in the result."""
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).distinct()
    now = _written(pairs, "edges")
    n = now.count()
    for _ in range(rounds):
        if n == 0:
            break
        large, above = _large_star(now, n)
        if large is None:
            drop_written(above)
            break
        small, below = _small_star(large, n)
        last, now = now, _written(small, "edges")
        drop_written(last, above, below)
        let_go(edges.sparkSession)
        n = now.count()
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
