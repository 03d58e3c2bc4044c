"""Scalar column functions (I1-I14).  All are JVM-side Column expressions — they stay inside
whole-stage codegen; none is a Python UDF.  ANSI mode is on in Spark 4, so every parse uses
the ``try_`` variant and every element access uses ``get`` (NULL instead of an error).
"""

from __future__ import annotations

import sys
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "c", "as_array", "parse_date", "year_of", "to_int", "count_text_to_int", "delivered_date",
    "default", "flag01", "json_text", "lower_eq", "contains_any", "char_len",
    "first_item_dashboard", "first_item_modelling", "metric_block", "json_records",
    "prediction_text", "confidence_pct", "gauge_band", "percent_of_total", "typed_null",
]


def c(name: str) -> Column:
    """Column by (possibly dotted) path whose parts contain ':' '@' '-' or '$'."""
    parts = name.split(".")
    col = F.col(f"`{parts[0]}`")
    for p in parts[1:]:
        col = col.getField(p)
    return col


def typed_null(dtype: T.DataType | str) -> Column:
    return F.lit(None).cast(dtype)


def as_array(raw: Column, element: T.DataType) -> Column:
    """Object-or-list JSON text -> array<element>.  A single object becomes a 1-element list;
    NULL stays NULL; malformed text gives NULL."""
    arr_t = T.ArrayType(element)
    t = F.trim(raw)
    return F.when(t.startswith("["), F.from_json(t, arr_t)).otherwise(
        F.from_json(F.concat(F.lit("["), t, F.lit("]")), arr_t)
    )


# I1 ------------------------------------------------------------------------------------
def parse_date(col: Column) -> Column:
    """``to_date`` that yields NULL for unparsable text (plain ``to_date`` throws under ANSI)."""
    return F.try_to_date(col)


def year_of(col: Column) -> Column:
    return F.year(F.try_to_date(col))


# I2 / I10 ------------------------------------------------------------------------------
def to_int(col: Column, default: int | None = None, dtype: str = "int") -> Column:
    v = F.trim(col.cast("string")).try_cast(dtype) if dtype else col
    return v if default is None else F.coalesce(v, F.lit(default).cast(dtype))


def count_text_to_int(col: Column, dtype: str = "bigint") -> Column:
    """'1,234' -> 1234; anything unparsable (or NULL) -> 0."""
    return F.coalesce(F.trim(F.regexp_replace(col, ",", "")).try_cast(dtype), F.lit(0).cast(dtype))


# I3 ------------------------------------------------------------------------------------
def delivered_date(y: Column, m: Column, d: Column) -> Column:
    """concat_ws skips NULL parts; all NULL -> ''."""
    return F.concat_ws("-", y, m, d)


# I4 / I5 / I6 --------------------------------------------------------------------------
def default(col: Column, value) -> Column:
    return F.coalesce(col, F.lit(value))


def flag01(col: Column) -> Column:
    return F.coalesce(col.cast("boolean"), F.lit(False)).cast("int")


def json_text(col: Column) -> Column:
    return F.to_json(col)


# I7 ------------------------------------------------------------------------------------
def lower_eq(col: Column, value: str) -> Column:
    """Case-insensitive equality; NULL counts as 'not equal' (pandas semantics)."""
    return F.coalesce(F.lower(col) == F.lit(value.lower()), F.lit(False))


def contains_any(col: Column, phrases: Iterable[str]) -> Column:
    """Lower-cased substring test against literal phrases; NULL text -> false."""
    low = F.lower(col)
    cond = None
    for p in phrases:
        term = low.contains(F.lit(p.lower()))
        cond = term if cond is None else (cond | term)
    return F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(False)


# I8 ------------------------------------------------------------------------------------
def char_len(col: Column) -> Column:
    """Length in code points (as Python ``len``); NULL stays NULL."""
    return F.char_length(col)


#: What ``str.strip()`` takes off.
WHITE_SPACE = "".join(chr(c) for c in range(sys.maxunicode) if chr(c).isspace())


# I9 ------------------------------------------------------------------------------------
def first_item_dashboard(col: Column) -> Column:
    """``strip('[]').split(',')[0].strip()``; NULL -> NULL, '' -> ''.  ``strip()`` takes all
    white space off, not only blanks."""
    return F.btrim(F.get(F.split(F.btrim(col, F.lit("[]")), ",", -1), 0), F.lit(WHITE_SPACE))


def first_item_modelling(col: Column) -> Column:
    """``split(',')[0][1:]``; NULL and '' -> NULL."""
    return F.when(col.isNull() | (col == ""), typed_null("string")).otherwise(
        F.substring(F.split_part(col, F.lit(","), F.lit(1)), 2, 1 << 30)
    )


# I11 -----------------------------------------------------------------------------------
def metric_block(block: Column, co_authors: Column, cited_by: Column, preprints: Column) -> list[Column]:
    """Parse captured metric text: lines 0/2/4 of the block are citations / documents /
    h-index; word 0 of co-author and preprint text when it has a blank; word 2 of the
    cited-by text when it has more than two words; else 0."""
    lines = F.split(block, "\n", -1)

    def line(i: int) -> Column:
        return count_text_to_int(F.get(lines, i))

    def word0(txt: Column) -> Column:
        return F.when(F.coalesce(txt.contains(" "), F.lit(False)), count_text_to_int(F.split_part(txt, F.lit(" "), F.lit(1)))).otherwise(F.lit(0).cast("bigint"))

    words = F.split(cited_by, " ", -1)
    cited = F.when(F.coalesce(F.size(words) > 2, F.lit(False)), count_text_to_int(F.get(words, 2))).otherwise(F.lit(0).cast("bigint"))
    return [
        line(0).alias("citations"),
        line(2).alias("documents"),
        line(4).alias("h_index"),
        word0(co_authors).alias("co_authors_count"),
        cited.alias("cited_by_count"),
        word0(preprints).alias("preprints_count"),
    ]


# I12 -----------------------------------------------------------------------------------
def json_records(col: Column, element: T.DataType) -> Column:
    return as_array(col, element)


# I13 -----------------------------------------------------------------------------------
def prediction_text(pred: Column) -> Column:
    from biblioflow.functions.terms import NEGATIVE_TEXT, POSITIVE_TEXT

    return F.when(pred == 1, F.lit(POSITIVE_TEXT)).otherwise(F.lit(NEGATIVE_TEXT))


def confidence_pct(p0: Column, p1: Column) -> Column:
    return F.round(F.greatest(p0, p1) * 100.0, 2)


def gauge_band(p1: Column) -> Column:
    """0 = [0,33), 1 = [33,66), 2 = [66,100] of the positive-class probability in percent."""
    from biblioflow.functions.terms import GAUGE_EDGES

    pct = p1 * 100.0
    return F.when(pct < GAUGE_EDGES[1], 0).when(pct < GAUGE_EDGES[2], 1).otherwise(2)


# I14 -----------------------------------------------------------------------------------
def percent_of_total(df: DataFrame, value: str, alias: str = "pct", digits: int = 4) -> DataFrame:
    """100 * x / sum(x) with the total as a scalar subquery (one-row aggregate, no
    single-partition window, no cross join)."""
    total = df.select(F.sum(F.col(value))).scalar()
    return df.withColumn(alias, F.round(F.try_divide(F.col(value) * 100.0, total), digits))
