"""Filters, labels and validation (D1-D12).  All are row-local predicates that Catalyst
pushes below projections/generators and, where they touch scan columns, into the Parquet
scan (``PushedFilters``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.functions.columns import contains_any, lower_eq
from biblioflow.functions.terms import (
    CONFERENCE_INDICATORS, CONFERENCE_PAPER, CONFERENCE_PROCEEDING, EXCLUSION_TERMS, MIN_REFERENCES,
    PROCEEDING_PHRASE, UNKNOWN_ID,
)

DT, ST = "document_type", "source_type"


# D1 ------------------------------------------------------------------------------------
def key_present(df: DataFrame, key: str = "doi") -> DataFrame:
    return df.filter(F.col(f"`{key}`").isNotNull())


# D2 ------------------------------------------------------------------------------------
def consistent_type_filter(df: DataFrame) -> DataFrame:
    """Keep (conference paper AND proceeding) OR (not conference paper AND not proceeding),
    SQL three-valued: a NULL document or source type drops the row."""
    cp = F.col(DT) == CONFERENCE_PAPER
    pr = F.col(ST) == CONFERENCE_PROCEEDING
    return df.filter((cp & pr) | (~cp & ~pr))


def paper_load_filter(df: DataFrame) -> DataFrame:
    """D1 + D2 as applied by the nested-paper load."""
    return consistent_type_filter(key_present(df, "doi"))


# D3 ------------------------------------------------------------------------------------
def type_category(df: DataFrame) -> DataFrame:
    """2x2 cell by case-insensitive equality, NULL counting as 'not' (pandas semantics):
    0 = conference paper in proceeding, 1 = conference paper elsewhere,
    2 = other type in proceeding, 3 = neither."""
    cp = lower_eq(F.col(DT), CONFERENCE_PAPER)
    pr = lower_eq(F.col(ST), CONFERENCE_PROCEEDING)
    return df.withColumn("category", F.when(cp & pr, 0).when(cp, 1).when(pr, 2).otherwise(3))


# D5 ------------------------------------------------------------------------------------
def _cp_not_proceeding() -> Column:
    # pandas: (dt == CP) & (st != CPr); NULL != x is True in pandas
    return F.col(DT).eqNullSafe(CONFERENCE_PAPER) & ~F.col(ST).eqNullSafe(CONFERENCE_PROCEEDING)


def label_v2(df: DataFrame) -> DataFrame:
    """Drop conference papers outside proceedings; label the rest
    ``is_full_conference = (conference paper AND proceeding)`` — NULL types kept, False."""
    kept = df.filter(~_cp_not_proceeding())
    return kept.withColumn(
        "is_full_conference",
        F.col(DT).eqNullSafe(CONFERENCE_PAPER) & F.col(ST).eqNullSafe(CONFERENCE_PROCEEDING),
    )


# D6 ------------------------------------------------------------------------------------
def v1_flags(df: DataFrame, title: str = "source_title", stype: str = "source_type", refs: str = "ref_count") -> DataFrame:
    """Columns used by the V1 rule; NULL text matches nothing."""
    return df.select(
        "*",
        contains_any(F.col(title), EXCLUSION_TERMS).alias("has_exclusion_term"),
        contains_any(F.col(stype), (PROCEEDING_PHRASE,)).alias("has_conference_proceeding"),
        contains_any(F.col(title), CONFERENCE_INDICATORS).alias("has_conference_indicator"),
        F.coalesce(F.col(refs) >= MIN_REFERENCES, F.lit(False)).alias("has_minimum_references"),
    )


def label_v1(df: DataFrame, **names: str) -> DataFrame:
    """Keyword rule: no exclusion term, source type contains 'conference proceeding', an
    indicator phrase in the source title, and at least 5 references."""
    f = v1_flags(df, **names)
    return f.withColumn(
        "is_full_conference",
        ~F.col("has_exclusion_term") & F.col("has_conference_proceeding")
        & F.col("has_conference_indicator") & F.col("has_minimum_references"),
    )


# D7 ------------------------------------------------------------------------------------
def drop_missing(df: DataFrame, *cols: str) -> DataFrame:
    return df.na.drop(subset=list(cols or ["ref_count"]))


# D8 ------------------------------------------------------------------------------------
def anomaly_slice(df: DataFrame) -> DataFrame:
    """Conference papers not in a proceeding (pandas mask: NULL source type counts)."""
    return df.filter(_cp_not_proceeding())


# D4 / F13 ------------------------------------------------------------------------------
def validate_counted(df: DataFrame, key: str, name: str = "validation"):
    """Drop NULL-key rows while counting input and dropped rows in the same pass
    (``DataFrame.observe``; metrics appear after the first action on the result)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    k = F.col(f"`{key}`")
    observed = df.observe(obs, F.count(F.lit(1)).alias("input_rows"), F.count_if(k.isNull()).alias("dropped_rows"))
    return observed.filter(k.isNotNull()), obs


# D9 ------------------------------------------------------------------------------------
def missing_metric_ids(df: DataFrame) -> DataFrame:
    """Authors whose metric block has no ``citations`` -> ``{@auid}`` for reprocessing."""
    return df.filter(F.col("author_stat.citations").isNull()).select(F.col("auid").alias("@auid"))


# D10 -----------------------------------------------------------------------------------
def failed_id_log(df: DataFrame, key: str = "@auid") -> DataFrame:
    """De-duplicated failed ids; unknown id -> 'UNKNOWN'."""
    return df.select(F.coalesce(F.col(f"`{key}`"), F.lit(UNKNOWN_ID)).alias("auid")).dropDuplicates()


# D11 -----------------------------------------------------------------------------------
def range_slice(df: DataFrame, upper: int = 100) -> DataFrame:
    return df.filter(~F.col("is_full_conference") & (F.col("ref_count") < upper))


# D12 -----------------------------------------------------------------------------------
def valid_ids(df: DataFrame, key: str) -> DataFrame:
    k = F.col(f"`{key}`")
    return df.filter(k.isNotNull() & (F.length(k) > 0) & (k != UNKNOWN_ID))
