"""Scans (A1-A14).  Files are read by executors (one task per file split, or per file for
whole-text formats); the driver only lists paths.  Every JSON reader takes an explicit
schema and returns the parsed rows plus, where the source format can be broken, a
rejects frame instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.session import scratch_path
from biblioflow.sources.pieces import EITHER, ELEMENTS, OBJECTS, csv_records, cut_files, file_lines, fragment_texts, joined_fragments

# A1 / A2 / A3 ---------------------------------------------------------------------------
def tagged(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (with a column ``verdict``) written once, a folder per verdict, and read back:
    good rows and rejects come from one pass over the input, and each reads its own folder."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.partitionBy("verdict").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _read_pieces(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, glob: str | None, mode: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of JSON files cut into objects (``pieces``)."""
    record = F.from_json("json", schema).alias("r")

    def judged(df: DataFrame, *more: str) -> DataFrame:
        verdict = F.when(F.col("part").isNotNull(), "part").when(F.col("error").isNotNull(), "bad").otherwise("good")
        return df.withColumn("verdict", verdict).select(
            "file_path", "block_start", "ordinal", F.when(F.col("verdict") == "good", record).alias("r"), "error", "bad_text", *more, "verdict")

    cut = tagged(judged(cut_files(file_lines(spark, path, glob), mode), F.when(F.col("part").isNotNull(), F.col("json")).alias("json"), "part", "mode"), "pieces")
    joined = joined_fragments(cut.where("verdict = 'part'")).withColumn("part", F.lit(None).cast("string"))
    both = cut.where("verdict <> 'part'").drop("json", "part", "mode").unionByName(tagged(judged(joined), "joined-pieces"))
    good = both.where("verdict = 'good'").select("file_path", "block_start", "ordinal", "r.*")
    return good, both.where("verdict = 'bad'").select("file_path", "block_start", "ordinal", "error", "bad_text")


def read_concatenated_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, glob: str | None = "*.json"):
    """A1: files of concatenated objects -> (records, rejects).  A file is read by as many tasks
    as it has ranges.  ``block_start`` and ``ordinal`` give a file's order.  A file that
    doesn't begin with '{' is rejected, a reject for each range it is read in; a bad object
    is rejected with its text, and reading goes on behind it."""
    return _read_pieces(spark, path, schema, glob, OBJECTS)


def read_lenient_array(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, glob: str | None = "*.json"):
    """A2: JSON-array files that may lack brackets or end with a comma -> (records, rejects).
    Elements are cut apart one by one, so one bad element is one reject."""
    return _read_pieces(spark, path, schema, glob, ELEMENTS)


def read_array_or_objects(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, glob: str | None = "*.json"):
    """A3: a file is a JSON array, a single object, or concatenated objects -> (records, rejects)."""
    return _read_pieces(spark, path, schema, glob, EITHER)


# A4 ------------------------------------------------------------------------------------
def read_json_inferred(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Schema inference pass over all input (distributed), then the scan."""
    return spark.read.option("multiLine", multiline).json(path)


# A5 ------------------------------------------------------------------------------------
def read_json_fixed(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Fixed schema: missing keys -> NULL, extra keys dropped."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def parse_json_column(df: DataFrame, column: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.from_json(F.col(column), schema).alias("_r")).select(*keep, "_r.*")


# A6 ------------------------------------------------------------------------------------
def year_glob(base: str, first: int, last: int) -> str:
    years = ",".join(str(y) for y in range(first, last + 1))
    return f"{base.rstrip('/')}/{{{years}}}"


def read_year_folders(spark: SparkSession, base: str, schema: T.StructType, first: int, last: int,
                      glob: str = "*.json", multiline: bool = False) -> DataFrame:
    """One multi-path scan of ``base/<year>/`` for years in range; only those directories
    are listed.  ``year`` comes from the file path."""
    df = (spark.read.schema(schema).option("multiLine", multiline).option("pathGlobFilter", glob)
          .json(year_glob(base, first, last)))
    return df.withColumn("year", F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4})/[^/]*$", 1).cast("int"))


def read_partitioned_years(spark: SparkSession, base: str, schema: T.StructType, first: int, last: int,
                           column: str = "year") -> DataFrame:
    """Year-partitioned layout (``base/year=YYYY/``): the range predicate on the partition
    column prunes whole directories at planning time (``PartitionFilters``)."""
    full = T.StructType(list(schema.fields) + [T.StructField(column, T.IntegerType())])
    df = spark.read.schema(full).json(base)
    return df.where(F.col(column).between(first, last))


# A7 ------------------------------------------------------------------------------------
def year_coverage(spark: SparkSession, base: str, first: int, last: int, glob: str = "*.json",
                  folder: str = "{}") -> DataFrame:
    """(year, status): 'missing' (no folder), 'empty' (folder without JSON files), 'ok'.
    Folder existence is a metadata call per expected year (bounded); the file listing is
    a distributed ``binaryFile`` scan that reads no content."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    present = []
    for y in range(first, last + 1):
        p = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{folder.format(y)}")
        present.append((y, bool(p.getFileSystem(conf).exists(p))))
    expected = spark.createDataFrame(present, "year int, folder boolean")
    years = ",".join(folder.format(y) for y in range(first, last + 1))
    try:
        listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("basePath", base)
                   .load(f"{base.rstrip('/')}/{{{years}}}")
                   .select(F.regexp_extract("path", r"/(?:[a-z_]+=)?(\d{4})/[^/]*$", 1).cast("int").alias("year"))
                   .groupBy("year").agg(F.count(F.lit(1)).alias("files")))
    except AnalysisException as e:  # no year folder matched at all; anything else is an error
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        listing = spark.createDataFrame([], "year int, files long")
    j = expected.join(listing, "year", "left")
    return j.select("year", F.when(~F.col("folder"), "missing").when(F.coalesce("files", F.lit(0)) == 0, "empty")
                    .otherwise("ok").alias("status"), F.coalesce("files", F.lit(0)).alias("files"))


# A8 ------------------------------------------------------------------------------------
def read_json_with_rejects(spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = True):
    """PERMISSIVE parse with a corrupt-record column; returns (good, rejects), both from one
    pass over the files (``tagged``).

    Files are scanned as text (one row per line, or per file when ``multiline``) and parsed
    with ``from_json``: the same distributed scan as the JSON source, without its ban on
    queries that only touch the corrupt-record column.  Blank lines and empty files are
    skipped, not rejected."""
    src = spark.read.text(path, wholetext=multiline).select(F.col("_metadata.file_path").alias("file_path"), "value")
    src = src.where(F.length(F.trim("value")) > 0)
    s = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = src.select("file_path", F.from_json("value", s, opts).alias("r"))
    rows = tagged(parsed.withColumn("verdict", F.when(F.col("r._corrupt_record").isNull(), "good").otherwise("bad")), "json-lines")
    good = rows.where("verdict = 'good'").select("file_path", *[F.col("r").getField(f.name).alias(f.name) for f in schema.fields])
    return good, rows.where("verdict = 'bad'").select("file_path", F.col("r._corrupt_record").alias("_corrupt_record"))


def processed_skipped(good: DataFrame, bad: DataFrame) -> DataFrame:
    """Files with good rows and files with rejects."""
    seen = good.select("file_path", F.lit(True).alias("good")).unionByName(bad.select("file_path", F.lit(False).alias("good")))
    files = seen.groupBy("file_path").agg(F.bool_or("good").alias("good"), F.bool_and("good").alias("clean"))
    return files.agg(F.count_if("good").alias("processed"), F.count_if(~F.col("clean")).alias("skipped"))


# A9 / A11 ------------------------------------------------------------------------------
def read_table(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.limit(limit) if limit else df


# A10 -----------------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = False) -> DataFrame:
    """CSV with a header and doubled quotes.  By default a record is a line, and Spark splits
    files anywhere.  With ``multiline`` quoted fields may hold line breaks: records are put
    together from lines by their quotes, range by range (``csv_records``), so large files
    are read by several tasks too; columns are taken by position.  Without a schema types are
    inferred, for ``multiline`` by Spark's own reader, one task a file."""
    r = spark.read.option("header", True).option("escape", '"')
    if not multiline:
        return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)
    if schema is None:
        schema = r.option("inferSchema", True).option("multiLine", True).csv(path).schema
    rows = tagged(csv_records(file_lines(spark, path)).withColumn("verdict", F.when(F.col("part").isNull(), "good").otherwise("part")), "csv-records")
    joined = fragment_texts(rows.where("verdict = 'part'").withColumn("mode", F.lit(None).cast("string")))
    every = rows.where("verdict = 'good'").select("block_start", "ordinal", "json").unionByName(joined.select("block_start", "ordinal", F.col("text").alias("json")))
    text = F.regexp_replace("json", r"\r$", "")
    records = every.where("not (block_start = 0 and ordinal = 0)").where(text != "")  # without headers and blank lines
    return records.select(F.from_csv(text, schema.toDDL(), {"escape": '"', "quote": '"', "multiLine": "true"}).alias("r")).select("r.*")


# A12 -----------------------------------------------------------------------------------
def kafka_stream(spark: SparkSession, servers: str, topics: Sequence[str]) -> DataFrame:
    """Topic scan from the earliest offset (needs the Kafka connector on the classpath)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest").load())


# A13 -----------------------------------------------------------------------------------
def read_lines(spark: SparkSession, path: str, name: str = "doi") -> DataFrame:
    """Text lines, trimmed (empty lines kept as '')."""
    return spark.read.text(path).select(F.trim(F.col("value")).alias(name))


# A14 -----------------------------------------------------------------------------------
def read_embeddings(spark: SparkSession, path: str, column: str = "embedding") -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    df = spark.read.parquet(path)
    return df.withColumn("features", array_to_vector(F.col(column)))


def embeddings_to_arrays(df: DataFrame, column: str = "features", out: str = "embedding") -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return df.withColumn(out, vector_to_array(F.col(column), "float32")).drop(column)
