"""Joins and set operations (E1-E5, G1-G3).

No join here carries a broadcast hint: every lookup side (reference counts, profiles,
known DOIs) grows with the data, so Catalyst/AQE choose the strategy at runtime
(broadcast only when the measured side is under ``autoBroadcastJoinThreshold``,
sort-merge otherwise, with skewed partitions split).  Every lookup side is made unique on
its key *before* the join with a hash aggregate (partial aggregation map-side), so a hot
key can neither fan out nor pile up in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.functions.columns import c


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple, ties broken by a hash of
    the whole row.  Expressed as ``max(struct(order.., hash, row))`` — a hash aggregate with
    map-side partial aggregation, so a key holding a third of all rows still reduces to one
    row per map task before the shuffle (a row_number window would sort it in one task)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [x for x in df.columns if x not in keys]
    tie = F.xxhash64(*[F.col(f"`{x}`") for x in df.columns])
    packed = F.struct(*[F.col(f"`{o}`").alias(f"_o{i}") for i, o in enumerate(order)], tie.alias("_tie"),
                      *[F.col(f"`{x}`").alias(x) for x in rest])
    agg = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max(packed).alias("_w"))
    return agg.select(*[F.col(f"`{k}`") for k in keys], *[F.col("_w").getField(x).alias(x) for x in rest])


# E1 ------------------------------------------------------------------------------------
def largest_refcounts(refcounts: DataFrame) -> DataFrame:
    """``DOI, References``: the largest count of each DOI."""
    return refcounts.where(F.col("DOI").isNotNull()).groupBy("DOI").agg(F.max("References").alias("References"))


def join_refcounts(papers: DataFrame, refcounts: DataFrame, doi: str = "prism:doi") -> DataFrame:
    """Left join papers with reference counts on DOI, ``ref_count`` 0 when absent.  The
    right side is reduced to one row per DOI (largest count) so duplicates cannot fan out."""
    right = largest_refcounts(refcounts).select(F.col("DOI").alias("_ref_doi"), F.col("References").alias("ref_count"))
    j = papers.join(right, c(doi) == F.col("_ref_doi"), "left")
    return j.drop("_ref_doi").withColumn("ref_count", F.coalesce(F.col("ref_count"), F.lit(0)))


# E2 ------------------------------------------------------------------------------------
def enrich_by_key(base: DataFrame, updates: DataFrame, key: str, fields: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """Overwrite ``fields`` of ``base`` from ``updates`` matched on ``key`` — only where the
    new value is present (``coalesce(new, old)``).  Updates are reduced to one row per key
    first; ``_matched`` marks rows that found an update (for F9)."""
    u = updates.where(F.col(f"`{key}`").isNotNull())
    cols = list(dict.fromkeys([key, *fields, *(order or [])]))
    u = latest_per_key(u.select(*[F.col(f"`{x}`") for x in cols]), key, order or list(fields))
    ren = u.select(F.col(f"`{key}`").alias("_u_key"), *[F.col(f"`{f}`").alias(f"_u_{f}") for f in fields])
    j = base.join(ren, F.col(f"`{key}`") == F.col("_u_key"), "left")
    for f in fields:
        j = j.withColumn(f, F.coalesce(F.col(f"_u_{f}"), F.col(f"`{f}`")) if f in base.columns else F.col(f"_u_{f}"))
    return j.withColumn("_matched", F.col("_u_key").isNotNull()).drop("_u_key", *[f"_u_{f}" for f in fields])


# E3 ------------------------------------------------------------------------------------
def enrich_affiliations(ids: DataFrame, profiles: DataFrame, key: str = "@affid", prefix: str = "p_") -> DataFrame:
    """Attach profile fields by affiliation id.  A matched profile overwrites even with
    NULLs (C15); a missing ``metrics`` block becomes an empty struct."""
    from biblioflow.operators.reshape import PROFILE_FIELDS, copy_profile_fields

    prof = latest_per_key(profiles.where(F.col(f"`{key}`").isNotNull()), key, ["preferredName"])
    metrics_t = prof.schema["metrics"].dataType
    empty_metrics = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in metrics_t.fields])
    sel = [F.col(f"`{key}`").alias("_p_key")]
    for f in PROFILE_FIELDS:
        col = F.coalesce(F.col(f), empty_metrics) if f == "metrics" else F.col(f"`{f}`")
        sel.append(col.alias(f"{prefix}{f}"))
    j = ids.join(prof.select(*sel), F.col(f"`{key}`") == F.col("_p_key"), "left")
    j = j.withColumn("_matched", F.col("_p_key").isNotNull()).drop("_p_key")
    return copy_profile_fields(j, prefix)


# E4 ------------------------------------------------------------------------------------
def enrich_abstract_keywords(papers: DataFrame, extra: DataFrame, key: str = "eid", keep_unmatched: bool = False) -> DataFrame:
    """Attach ``abstract`` and ``author-keyword`` fetched per ``eid`` (first abstract or
    NULL, keywords or []).  A paper whose details could not be fetched is not emitted
    (source behaviour) unless ``keep_unmatched``."""
    e = latest_per_key(extra.where(F.col(key).isNotNull()), key, ["abstract"])
    e = e.select(F.col(key).alias("_e_key"), F.col("abstract").alias("_e_abstract"),
                 F.coalesce(F.col("`author-keyword`"), F.array().cast("array<string>")).alias("_e_kw"))
    j = papers.join(e, F.col(f"`{key}`") == F.col("_e_key"), "left" if keep_unmatched else "inner")
    return (j.withColumn("abstract", F.col("_e_abstract"))
             .withColumn("author-keyword", F.col("_e_kw"))
             .drop("_e_key", "_e_abstract", "_e_kw"))


# E5 / G3 -------------------------------------------------------------------------------
def new_papers(papers: DataFrame, known: DataFrame, doi: str = "doi", known_doi: str = "doi") -> DataFrame:
    """Papers with a DOI that is not already held.  Left-anti join, so duplicates in
    ``papers`` are kept (``subtract`` would de-duplicate).  The known side is reduced to
    distinct keys first, map-side too, so a key that it repeats a million times is one row."""
    k = known.select(F.col(f"`{known_doi}`").alias("_known")).where(F.col("_known").isNotNull()).distinct()
    p = papers.where(F.col(f"`{doi}`").isNotNull())
    return p.join(k, F.col(f"`{doi}`") == F.col("_known"), "left_anti")


# G1 / G2 -------------------------------------------------------------------------------
def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()
