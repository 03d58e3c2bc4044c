"""Sinks (B1-B9).  Writes are plain DataFrameWriter jobs (parallel, one file per task).
``upsert`` (last write wins, as a store's primary key does) is a pure function.  The stream
sinks are order-aware (``merge_latest``) and write each batch as a version of its own, so a
failed job leaves the earlier ones intact and a re-run is idempotent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.operators.joins import latest_per_key
from biblioflow.session import scratch_path


# B1 ------------------------------------------------------------------------------------
def upsert(existing: DataFrame, incoming: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Primary-key upsert: ``incoming`` reduced to one row per key (greatest ``order``,
    full-row hash tie-break), existing rows whose key reappears are replaced."""
    keys = [key] if isinstance(key, str) else list(key)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(f"`{k}`").isNotNull()
    inc = latest_per_key(incoming.where(present), keys, order)
    cols = [F.col(f"`{x}`") for x in existing.columns]
    kept = existing.join(inc.select(*[F.col(f"`{k}`") for k in keys]), keys, "left_anti")
    return kept.select(*cols).unionByName(inc.select(*[F.col(f"`{x}`") for x in existing.columns]))


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all present (a row without a key can't be upserted)."""
    for k in keys:
        df = df.where(F.col(f"`{k}`").isNotNull())
    return df


def merge_latest(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The greatest ``order`` per key over both frames, so a late re-delivery of an older
    record never replaces a newer one."""
    inc = with_keys(incoming, keys)
    return latest_per_key(inc if existing is None else existing.unionByName(inc.select(*existing.columns)), keys, order)


# Keyed tables --------------------------------------------------------------------------
# A keyed table is plain Parquet, partitioned by ``table_version`` and, if dealt by key hash,
# ``bucket_of_<n>``.  A batch writes one version and never touches an earlier one.

def _folder(version: int) -> str:
    return f"table_version={version:08d}"


def upsert_version(spark: SparkSession, base: str, incoming: DataFrame, key: str | Sequence[str],
                   order: Sequence[str], version: int) -> str:
    """Write ``merge_latest(version - 1, incoming)`` as a whole version; returns the path.
    Deterministic in (previous version, incoming), so a re-run of a failed batch is
    idempotent."""
    keys = [key] if isinstance(key, str) else list(key)
    base = base.rstrip("/")
    target = f"{base}/{_folder(version)}"
    current = None
    if version > 0:
        current = spark.read.schema(incoming.schema).parquet(f"{base}/{_folder(version - 1)}")
    merge_latest(current, incoming, keys, order).write.mode("overwrite").parquet(target)
    return target


def bucket_of(keys: Sequence[str], buckets: int) -> "F.Column":
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _current(rows: DataFrame, bucket: str, below: int | None = None) -> DataFrame:
    """Of each bucket the rows of its latest version, by a filter on partition columns: at most
    one term a bucket, from the partition values (no column is read for them)."""
    seen = rows.select("table_version", bucket)
    if below is not None:
        seen = seen.where(F.col("table_version") < below)
    by_version: dict[int, list[int]] = {}
    for b, v in seen.groupBy(bucket).agg(F.max("table_version").alias("v")).collect():  # one row per bucket
        by_version.setdefault(v, []).append(b)
    wanted = F.lit(False)
    for v, found in sorted(by_version.items()):
        wanted = wanted | ((F.col("table_version") == v) & F.col(bucket).isin(found))
    return rows.where(wanted)


def upsert_buckets(spark: SparkSession, base: str, incoming: DataFrame, key: str | Sequence[str],
                   order: Sequence[str], version: int, buckets: int = 64) -> str:
    """Order-aware keyed upsert that writes only the buckets which the incoming keys touch.

    1. incoming rows, staged with their bucket;
    2. the touched buckets' latest rows before ``version`` (partition filters), merged with
       them by ``merge_latest``;
    3. one partitioned write of the merged buckets as ``table_version=<version>``.

    Versions are numbered by the caller (a stream's batch ids).  A batch that failed, or is
    delivered again, is run again under its own number: it reads earlier versions only and
    overwrites its own, so it ends as if it had run once.  A bucket's earlier versions stay
    on disk, as snapshots; a table is made small again by upserting its current rows into a
    new folder, which is also how ``buckets`` is changed (a table keeps the number it began
    with; another one is an error)."""
    keys = [key] if isinstance(key, str) else list(key)
    bucket = f"bucket_of_{buckets}"
    staged_path = scratch_path(spark, "upsert-staged")
    with_keys(incoming, keys).withColumn(bucket, bucket_of(keys, buckets)).write.parquet(staged_path)
    staged = spark.read.schema(f"{incoming.schema.toDDL()}, {bucket} int").parquet(staged_path)
    touched = [r[0] for r in staged.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
    target = f"{base.rstrip('/')}/{_folder(version)}"
    current = None
    if version > 0:
        rows = spark.read.schema(f"{incoming.schema.toDDL()}, table_version int, {bucket} int").parquet(base)
        if rows.where(F.col(bucket).isNull()).limit(1).count():  # its folders are named by another number
            raise ValueError(f"the table under {base} is not dealt into {buckets} buckets")
        current = _current(rows.where(F.col(bucket).isin(touched)), bucket, below=version).select(*incoming.columns, bucket)
    merged = merge_latest(current, staged, keys, order)
    # rebalance on the bucket: AQE splits large buckets into advisory-sized files and packs small ones
    merged.hint("rebalance", bucket).write.mode("overwrite").partitionBy(bucket).parquet(target)
    return target


def read_keyed_table(spark: SparkSession, base: str) -> DataFrame:
    """The current rows of a table written by ``upsert_buckets``."""
    rows = spark.read.parquet(base)
    bucket = next(c for c in rows.columns if c.startswith("bucket_of_"))
    return _current(rows, bucket).drop("table_version", bucket)


# B2-B5 ---------------------------------------------------------------------------------
def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str, column: str = "doi") -> None:
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


# B6 ------------------------------------------------------------------------------------
def keyed_messages(df: DataFrame, key: str, default_key: str | None = None) -> DataFrame:
    """(key, value) message shape: key text (or a default), value = the record as JSON."""
    k = F.col(f"`{key}`").cast("string")
    if default_key is not None:
        k = F.coalesce(k, F.lit(default_key))
    return df.select(k.alias("key"), F.to_json(F.struct(*[F.col(f"`{x}`") for x in df.columns])).alias("value"))


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch publish (needs the Kafka connector on the classpath)."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save())


# B8 ------------------------------------------------------------------------------------
def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)
