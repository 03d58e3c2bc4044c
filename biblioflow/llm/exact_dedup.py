"""Exact duplicate removal with a heavy-hitter split (DataFrame and SQL functions only).

1. Each row becomes (id, SHA-256 of its text), written once; later passes read these narrow
   rows, not the texts.
2. Misra-Gries counters (``approx_top_k``, Spark's frequent-items sketch of that family,
   merged over partitions) name at most ``max_heavy`` digests that may be frequent.
3. The candidates are verified by exact counts; those with at least ``heavy_share`` of the
   rows are winners, at most ``min(max_heavy, 1 / heavy_share)`` rows.  They are broadcast,
   and a frequent digest's rows get their answer where they are read, without a shuffle.
4. All other digests, and the rows that carry a winner's id, go through an ordinary window
   by digest; a digest that is left there has less than ``heavy_share`` of the rows.

If the sketch misses a digest it only takes the ordinary way; the answer is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.session import scratch_path


def text_digest(text: str | Column = "text") -> Column:
    """Lower-case hex SHA-256 of the text in UTF-8 (null: empty)."""
    col = F.col(f"`{text}`") if isinstance(text, str) else text
    return F.sha2(F.coalesce(col.cast("string"), F.lit("")).cast("binary"), 256)


def heavy_digests(narrow: DataFrame, max_heavy: int, heavy_share: float, tracked: int) -> DataFrame:
    """Verified frequent digests: ``_heavy, _keep, _size`` (at most ``max_heavy`` rows)."""
    found = narrow.select(F.expr(f"approx_top_k(_digest, {max_heavy}, {tracked})").alias("_t"))
    named = found.select(F.explode(F.transform("_t", lambda x: x["item"])).alias("_digest"))
    counts = (narrow.join(F.broadcast(named), "_digest", "left_semi")  # at most max_heavy short strings
              .groupBy("_digest").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")))
    total = narrow.agg(F.count(F.lit(1)))
    return counts.where(F.col("_size") >= F.greatest(F.lit(2.0), total.scalar() * F.lit(heavy_share))).select(
        F.col("_digest").alias("_heavy"), "_keep", "_size")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, max_heavy: int = 256,
                     heavy_share: float = 0.001, tracked: int = 4096) -> DataFrame:
    """One row per input row: ``<id_col>, keep_id, group_size, kept, text_sha256``.

    Rows are equal when their texts are identical (null counts as the empty text); of equal
    rows that with the largest id stays.  A null id is smaller than any other; if several
    equal rows carry the largest id (or all ids are null), exactly one of them has
    ``kept = true``.  An empty table gives an empty result; other columns, whatever their
    names, are not read."""
    spark = docs.sparkSession
    path = scratch_path(spark, "digests")
    docs.select(F.col(f"`{id_col}`").alias("_id"), text_digest(text_col).alias("_digest")).write.parquet(path)
    narrow = spark.read.parquet(path)
    heavy_path = scratch_path(spark, "heavy")
    heavy_digests(narrow, max_heavy, heavy_share, tracked).write.parquet(heavy_path)
    heavy = spark.read.parquet(heavy_path)

    tagged = narrow.join(F.broadcast(heavy), F.col("_digest") == F.col("_heavy"), "left")  # <= max_heavy rows
    done = F.col("_heavy").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keep"))
    losers = tagged.where(done).select("_id", "_keep", "_size", F.lit(False).alias("_kept"), "_digest")
    w = Window.partitionBy("_digest")
    rest = tagged.where(~done).select(
        "_id", F.coalesce("_keep", F.max("_id").over(w)).alias("_keep"),
        F.coalesce("_size", F.count(F.lit(1)).over(w)).alias("_size"),
        (F.row_number().over(w.orderBy(F.col("_id").desc_nulls_last())) == 1).alias("_kept"), "_digest")
    out = losers.unionByName(rest)
    return out.select(F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"),
                      F.col("_size").cast("long").alias("group_size"), F.col("_kept").alias("kept"),
                      F.col("_digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` doesn't keep; all columns stay.

    Ids are unique keys here; rows that share both id and text are one row in the result."""
    kept = exact_duplicates(docs, id_col, text_col, **options).where("kept")
    keys = ["_key_id", "_key_null", "_key_digest"]

    def keyed(df: DataFrame, digest: Column, *more: Column) -> DataFrame:
        return df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_key_id"),
                         F.col(f"`{id_col}`").isNull().alias("_key_null"), digest.alias("_key_digest"), *more)

    wanted = keyed(kept, F.col("text_sha256"))
    match = keyed(docs, text_digest(text_col), F.struct("*").alias("_row")).join(wanted, keys)
    # rows that repeat a kept id and text: the join's partitioning and sort serve this window too
    one = match.withColumn("_copy", F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))
    return one.where("_copy = 1").select("_row.*")
