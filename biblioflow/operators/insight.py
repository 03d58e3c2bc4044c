"""Insight aggregates, orderings and quotas (F1-F15, H1-H4).

Every aggregate is a hash aggregate with map-side partial aggregation, so a group key that
holds a third of all rows is reduced per map task before the shuffle.  Global totals
(min/max, sums for percentages) are one-row aggregates used as scalar subqueries — never a
single-partition window, never a cross join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biblioflow.functions.columns import contains_any, first_item_dashboard, year_of
from biblioflow.functions.terms import CONFERENCE_INDICATORS, EXCLUSION_TERMS, PROCEEDING_PHRASE


# F1 / H2 -------------------------------------------------------------------------------
def value_counts(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Counts per non-NULL value, count-descending with the value as tie-break."""
    out = name or column
    return (df.where(F.col(column).isNotNull())
              .groupBy(F.col(column).alias(out)).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc(out)))


# F2 ------------------------------------------------------------------------------------
def pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
              .groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), a, b))


# F3 / H1 -------------------------------------------------------------------------------
def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Top-n value counts (TakeOrdered over the partial-aggregated counts)."""
    return value_counts(df, column).limit(n)


# F4 ------------------------------------------------------------------------------------
def by_year_and_type(df: DataFrame, date_col: str = "publication_date", type_col: str = "source_type") -> DataFrame:
    """Publications per (year, source type); unparsable date or NULL type dropped."""
    y = year_of(F.col(date_col).cast("string"))
    return (df.select(y.alias("year"), F.col(type_col).alias(type_col))
              .where(F.col("year").isNotNull() & F.col(type_col).isNotNull())
              .groupBy("year", type_col).agg(F.count(F.lit(1)).alias("n")))


# F5 ------------------------------------------------------------------------------------
def label_statistics(labelled: DataFrame, label: str = "is_full_conference") -> DataFrame:
    """Total, positives, percentage and the three phrase-hit counts in one pass."""
    return labelled.agg(
        F.count(F.lit(1)).alias("total_papers"),
        F.count_if(F.col(label)).alias("full_conference_papers"),
        F.round(F.try_divide(F.count_if(F.col(label)) * 100.0, F.count(F.lit(1))), 4).alias("percentage_full_conference"),
        F.count_if(contains_any(F.col("source_type"), (PROCEEDING_PHRASE,))).alias("total_has_conference_proceeding"),
        F.count_if(contains_any(F.col("source_title"), CONFERENCE_INDICATORS)).alias("total_has_conference_indicator"),
        F.count_if(contains_any(F.col("source_title"), EXCLUSION_TERMS)).alias("total_has_exclusion_terms"),
    )


# F6 ------------------------------------------------------------------------------------
def distinct_count(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(f(F.col(column)).alias(f"n_distinct_{column}"))


# F7 ------------------------------------------------------------------------------------
def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram over the observed [min, max]: ``bins`` bins, the last closed,
    empty bins present.  min/max are scalar subqueries; the bin frame has exactly ``bins``
    rows (a parameter, not data)."""
    spark = df.sparkSession
    x = F.col(column).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    lo = vals.select(F.min("x")).scalar()
    hi = vals.select(F.max("x")).scalar()
    width = (hi - lo)
    raw = F.floor(F.try_divide(F.col("x") - lo, width) * F.lit(bins)).cast("int")
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1)))
    counts = vals.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = frame.select(
        "bin",
        (lo + width * F.col("bin") / F.lit(bins)).alias("lower"),
        (lo + width * (F.col("bin") + 1) / F.lit(bins)).alias("upper"),
    )
    return edges.join(counts, "bin", "left").select("bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n"))


# F8 ------------------------------------------------------------------------------------
def count_where(df: DataFrame, cond: Column, name: str = "n") -> DataFrame:
    return df.agg(F.count_if(cond).alias(name))


# F9 ------------------------------------------------------------------------------------
def retrieval_stats(enriched: DataFrame, matched: str = "_matched") -> DataFrame:
    total = F.count(F.lit(1))
    ok = F.count_if(F.col(matched))
    return enriched.agg(
        total.alias("total"), ok.alias("success"), (total - ok).alias("failed"),
        F.round(F.try_divide(ok * 100.0, total), 4).alias("success_pct"),
    )


# F10 -----------------------------------------------------------------------------------
def distinct_author_ids(df: DataFrame, authors: str = "authors", field: str = "@auid") -> DataFrame:
    # explode_outer: a plain explode makes Catalyst add ``size(list) > 0`` on the generator
    # input, which re-evaluates (re-parses) the list expression; NULL rows are dropped below
    return (df.select(F.explode_outer(authors).alias("a"))
              .select(F.col("a").getField(field).alias("auid"))
              .where(F.col("auid").isNotNull()).distinct())


# F11 -----------------------------------------------------------------------------------
def distinct_affiliation_ids(df: DataFrame, authors: str = "authors", only_lists: bool = True) -> DataFrame:
    """Distinct author-affiliation ids.  With ``only_lists`` (source rule) an affiliation
    given as a single object is ignored."""
    from biblioflow import schemas as S
    from biblioflow.functions.columns import as_array

    a = df.select(F.explode_outer(authors).alias("a")).select(F.col("a").getField("affiliation").alias("raw"))
    if only_lists:
        a = a.where(F.trim(F.col("raw")).startswith("["))
    ids = a.select(F.explode_outer(as_array(F.col("raw"), S.AUTHOR_AFFILIATION)).alias("x"))
    return ids.select(F.col("x").getField("@id").alias("affid")).where(F.col("affid").isNotNull()).distinct()


# F12 -----------------------------------------------------------------------------------
def subject_doctype_graph(df: DataFrame, subject: str = "main_subject_area", doc: str = "document_type"):
    """Bipartite graph: weighted edges per (subject, document type), nodes per side."""
    pairs = df.select(F.col(subject).alias("subject"), F.col(doc).alias("doc_type")).where(
        F.col("subject").isNotNull() & F.col("doc_type").isNotNull())
    edges = pairs.groupBy("subject", "doc_type").agg(F.count(F.lit(1)).alias("weight"))
    nodes = (edges.select(F.col("subject").alias("node"), F.lit("subject").alias("kind"))
             .union(edges.select(F.col("doc_type").alias("node"), F.lit("document_type").alias("kind")))
             .distinct())
    return nodes, edges


def main_subject(df: DataFrame, col: str = "subject_area") -> DataFrame:
    return df.withColumn("main_subject_area", first_item_dashboard(F.col(col)))


# F14 -----------------------------------------------------------------------------------
def coverage_matrix(df: DataFrame, year: str = "year", category: str = "category", categories: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """year x category counts; explicit pivot values (no driver-side distinct)."""
    out = df.groupBy(year).pivot(category, list(categories)).agg(F.count(F.lit(1)))
    return out.select(year, *[F.coalesce(F.col(str(k)), F.lit(0)).alias(f"cat_{k}") for k in categories])


# F15 -----------------------------------------------------------------------------------
def authors_per_paper(df: DataFrame, authors: str = "authors") -> Column:
    return F.coalesce(F.size(F.col(authors)), F.lit(0))


# H3 ------------------------------------------------------------------------------------
def top_k(df: DataFrame, score: str, k: int, name: str | None = None, ascending: bool = False) -> DataFrame:
    o = F.asc(score) if ascending else F.desc(score)
    tie = [F.asc(name)] if name else []
    return df.orderBy(o, *tie).limit(k)


#: Slices of a quota group that are cut down before the group is ranked.
SLICES = 64


# H4 ------------------------------------------------------------------------------------
def quota_frame(spark: SparkSession, quotas: Mapping[int, Sequence[int]]) -> DataFrame:
    rows = [(int(y), int(cat), int(q)) for y, qs in quotas.items() for cat, q in enumerate(qs)]
    return spark.createDataFrame(rows, "year int, category int, quota int")


def apply_quota(df: DataFrame, quotas: Mapping[int, Sequence[int]], order: Sequence[str],
                year: str = "year", category: str = "category", doi: str = "doi") -> DataFrame:
    """First ``quota`` papers with a DOI per (year, category), in ``order``.

    Two rank limits: each group is dealt over SLICES slices, of which at most the literal
    bound ``max(quota)`` rows stay (Spark plans a ``WindowGroupLimit`` before that shuffle),
    so the window over a whole group sees at most SLICES times that many rows, however many
    tasks and rows there are.  The quota frame has one row per (year, category) of the
    fixed table, a proven size bound, and is broadcast."""
    spark = df.sparkSession
    cap = max(q for qs in quotas.values() for q in qs)
    by = [F.col(o) for o in order]
    dealt = df.where(F.col(doi).isNotNull()).withColumn("_slice", F.pmod(F.xxhash64(*by, F.col(doi)), F.lit(SLICES)))
    part = F.row_number().over(Window.partitionBy(year, category, "_slice").orderBy(*by))
    few = dealt.withColumn("_rn", part).where(F.col("_rn") <= cap).drop("_rn", "_slice")
    ranked = few.withColumn("rn", F.row_number().over(Window.partitionBy(year, category).orderBy(*by)))
    q = F.broadcast(quota_frame(spark, quotas))
    return ranked.join(q, [year, category], "inner").where(F.col("rn") <= F.col("quota")).drop("quota")
