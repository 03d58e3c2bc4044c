"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

1. One pass over the texts leaves narrow rows (id, source, size in words, hash-random key),
   written once; later steps read these.
2. One row per source: its size, its weight by its rank, and its target.  The targets'
   water level is found from prefix sums in the order of cap / weight.
3. Rows are range-sorted by (source, key), so a source that holds a third of all rows is many
   ranges.  A range's running sum plus what earlier ranges of the source hold is a row's
   place in its source.
4. A source's budget is as many whole epochs as fit, then a prefix of its order, cut inside
   the last document so that the budget is met to the word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def prefix_sums(df: DataFrame, order: Sequence[str], values: dict[str, str], within: Sequence[str] = (),
                facts: DataFrame | None = None) -> DataFrame:
    """``df`` with one more column per item of ``values`` (new name: column): its sum over the
    rows of the same ``within`` columns (none of them null) that come earlier in ``order``, 0
    for the first.  ``order`` begins with the ``within`` columns.  ``facts`` (one row per
    group) adds its columns to the group's rows.

    Rows are dealt into ranges of ``order`` and written with their range's number; what
    earlier ranges hold of a group is one row per (range, group).  Rows meet it, and the
    group's facts, by range and group, so a group that holds a third of all rows stays split:
    no task sees more than one range's rows of a group."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.schema(f"{df.schema.toDDL()}, _range int").parquet(path)
    keys = ["_range", *within]
    held = placed.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in values.items()])
    earlier = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(*keys, *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in values])
    if facts is not None:
        offsets = offsets.join(facts, list(within))
    here = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.join(offsets, keys)
    added = [(F.col(f"_o_{n}") + F.coalesce(F.sum(c).over(here), F.lit(0))).alias(n) for n, c in values.items()]
    return rows.select(*df.columns, *(c for c in (facts.columns if facts is not None else ()) if c not in within), *added)


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    """``_null, _source, source_size, target`` from one row per source (``_null, _source,
    source_size``).  Sources in code-point order, null last, take ``weights`` in turn.

    A source's target is its weight's part of ``share`` times all sizes, but at most
    ``max_epochs`` times its size; what that leaves over is shared again by weight until no
    target is above its bound.  In the order of bound / weight, a source is bounded exactly if
    the level over itself and all later ones lies above its own bound / weight."""
    spark = sizes.sparkSession
    ranked = prefix_sums(sizes.withColumn("_one", F.lit(1)), ["_null", "_source"], {"_rank": "_one"})
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    priced = (ranked.withColumn("_weight", weight.cast("long")).withColumn("_cap", F.col("source_size") * F.lit(int(max_epochs)))
              .withColumn("_ratio", F.col("_cap") / F.col("_weight")))
    path = scratch_path(spark, "levels")
    prefix_sums(priced, ["_ratio", "_null", "_source"], {"_cap_before": "_cap", "_weight_before": "_weight"}).write.parquet(path)
    rows = spark.read.parquet(path)
    total = rows.agg(F.sum("source_size").alias("_size"), F.sum("_weight").alias("_weights"))
    budget, all_weights = total.select(F.col("_size") * F.lit(float(share))).scalar(), total.select("_weights").scalar()
    level = (budget - F.col("_cap_before")) / (all_weights - F.col("_weight_before"))
    flagged = rows.withColumn("_bounded", level > F.col("_ratio"))
    fixed = flagged.agg(F.coalesce(F.sum(F.when(F.col("_bounded"), F.col("_cap"))), F.lit(0)).alias("_caps"),
                        F.sum(F.when(~F.col("_bounded"), F.col("_weight"))).alias("_open"))
    left, open_weights = budget - fixed.select("_caps").scalar(), fixed.select("_open").scalar()
    target = F.when(F.col("_bounded"), F.col("_cap")).otherwise(F.least(F.col("_cap"), left * F.col("_weight") / open_weights))
    return flagged.select("_null", "_source", "source_size", target.cast("double").alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1,), *, share: float = 1.0, max_epochs: int = 2, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: ``<id_col>, size, source_size, target, taken, epochs, cut``.

    ``size`` is the text's number of words (null: 0), ``target`` its source's (see
    ``source_targets``).  The mix takes ``epochs`` whole copies of the row and the first
    ``cut`` words of one more; ``taken`` is the words of both.  A source's budget is its
    target without the fraction: the whole epochs that fit, then documents in the order of
    MD5(``seed``, id), ties by id and size; the document at the budget's end is cut.  So the
    sum of ``taken`` is less than one word below the target, no document is taken more than
    ``max_epochs`` times, and reruns agree on any number of tasks.

    A null source is a source of its own, the last; a null id counts as the empty text in the
    key.  Rows that agree in source, id and size are interchangeable: which of them is cut is
    open.  Documents without words take nothing; a source of such documents has target 0.
    Very long texts are counted whole.  An empty table gives an empty result; other columns
    aren't read."""
    if not weights or min(weights) < 1 or share < 0 or share > max_epochs:
        raise ValueError("weights must be positive, and share between 0 and max_epochs")
    spark = docs.sparkSession
    col = lambda name: F.col(f"`{name}`")
    source = col(source_col).cast("string")
    path = scratch_path(spark, "mix-rows")
    docs.select(col(id_col).alias("_id"), source.isNull().alias("_null"), F.coalesce(source, F.lit("")).alias("_source"),
                F.coalesce(F.regexp_count(col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("_key"),
                ).write.parquet(path)
    narrow = spark.read.parquet(path)
    sizes = narrow.groupBy("_null", "_source").agg(F.sum("size").alias("source_size"))
    targets_path = scratch_path(spark, "mix-targets")
    source_targets(sizes, weights, share, max_epochs).write.parquet(targets_path)
    targets = spark.read.parquet(targets_path)

    order = ["_null", "_source", "_key", "_id", "size"]
    rows = prefix_sums(narrow, order, {"_before": "size"}, ["_null", "_source"], targets)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("epochs", epochs)
    rest = budget - F.col("epochs") * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before"))).cast("long")
    return rows.withColumn("cut", cut).select(
        F.col("_id").alias(id_col), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("cut")).alias("taken"), "epochs", "cut")


def mixed_rows(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as its ``plan`` (``mix_sources``) takes it,
    with ``epoch`` (from 0) and the text; the copy at a budget's end keeps its first ``cut``
    words.  Ids are unique keys here."""
    copies = plan.where("taken > 0").select(
        F.col(id_col), F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - F.when(F.col("cut") > 0, 0).otherwise(1))).alias("epoch"),
        F.col("epochs").alias("_epochs"), F.col("cut").alias("_cut"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    text = F.when(F.col("epoch") == F.col("_epochs"), F.array_join(F.slice(words, F.lit(1), F.col("_cut").cast("int")), "")).otherwise(F.col(text_col))
    return copies.join(docs.select(id_col, text_col), id_col).select(id_col, "epoch", text.alias(text_col))
