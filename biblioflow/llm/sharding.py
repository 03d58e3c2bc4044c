"""Contiguous shards of near-equal bytes, from global prefix sums.

Rows are narrowed to (id, size, checksum), range-partitioned by id and written with their
partition's number.  Per-partition totals (one row per partition) give each partition's
offset, a running sum inside the partition gives each row's place in the whole order, and
the order is cut at equal targets.  No task sees more than one partition's narrow rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.session import scratch_path

LAW = "bytes"


def byte_balanced_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", *,
                         overhead: int = 16) -> DataFrame:
    """One row per input row: ``<id_col>, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes (null: none) plus ``overhead``.  In the order of
    (id, checksum, size), nulls first, a row belongs to the shard in which the middle of its
    bytes falls, so a shard differs from total / ``shards`` by less than one row's size and
    shards are ranges of that order.  ``slot`` counts a shard's rows from 0.  A row larger
    than a target leaves neighbouring shards without rows.  ``grown_shard`` is null: with
    other shard counts, rows move between neighbours.  Repeated rows each get a slot of
    their own; an empty table gives an empty result; other columns aren't read."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    narrow = docs.select(F.col(f"`{id_col}`").alias("_id"), (F.octet_length(body) + F.lit(overhead)).cast("long").alias("_size"),
                         F.crc32(body.cast("binary")).cast("long").alias("_crc"))
    order = ["_id", "_crc", "_size"]
    path = scratch_path(spark, "ranges")
    # the numbers of the ranges are written with the rows, so that they hold in both readings below
    (narrow.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(path))
    placed = spark.read.schema("_id {}, _size long, _crc long, _part int".format(narrow.schema["_id"].dataType.simpleString())).parquet(path)

    total = placed.groupBy("_part").agg(F.sum("_size").alias("_bytes"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = total.select("_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_before"),
                           F.sum("_bytes").over(Window.partitionBy(F.lit(0))).alias("_total"))
    run = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (placed.withColumn("_upto", F.sum("_size").over(run)).join(F.broadcast(offsets), "_part")  # rows: partitions
            .withColumn("_twice", 2 * (F.col("_before") + F.col("_upto")) - F.col("_size")))  # twice the middle
    shard = F.least(F.lit(shards - 1), F.expr(f"cast(cast(_twice as decimal(38,0)) * {shards} div (2 * _total) as int)"))
    rows = rows.withColumn("_shard", shard)
    rank = F.row_number().over(Window.partitionBy("_part", "_shard").orderBy(*order))
    ranked = rows.withColumn("_rank", rank)
    # how many rows of a shard lie in earlier partitions: one row per (partition, shard)
    held = ranked.groupBy("_part", "_shard").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("_part", "_shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    out = ranked.join(F.broadcast(starts), ["_part", "_shard"])  # at most partitions + shards rows
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                      F.lit(LAW).alias("law"), F.col("_shard").alias("shard"),
                      (F.col("_start") + F.col("_rank") - 1).cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
