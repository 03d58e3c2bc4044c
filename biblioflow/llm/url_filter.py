"""URL filter: host and path rules first, then a character language-model ratio.

URLs that a rule decides are the examples of accepted and of rejected ones.  For each class
a variable-order Markov model gives the probability of a character after its last
characters: Witten-Bell interpolation mixes the orders 0 to ``order``, so a context that was
never seen falls back to shorter ones.  An undecided URL is accepted if its mean
log-likelihood difference per character exceeds a threshold, calibrated for balanced
accuracy on a fold of the examples that the models didn't see.

All counts are DataFrames over all URLs.  A table of order k has one row per distinct gram,
so no join key there has more rows than the alphabet; grams that many URLs hold are joined
to the URLs by a broadcast of at most 1 / ``hot_share`` rows, the others by a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.session import scratch_path

#: Rules (verdict, host, path), from the query's contract.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
ORDER = 4
#: Equally likely characters below order 0.
ALPHABET = 256
START, STOP = "\u0002", "\u0003"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BINS = 1000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z as a-z (else empty)."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end (empty without ``://``)."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def scored_text(url: Column) -> Column:
    """What the models see: everything after the first ``://`` (A-Z of the host as a-z), or the
    whole text where there is none; null: empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.coalesce(F.when(F.contains(url, F.lit("://")), F.concat(host_of(url), rest)).otherwise(url), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits host (or a subdomain) and path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def grams(text: Column, size: int) -> Column:
    """All substrings of ``size`` characters, in order."""
    return F.transform(F.sequence(F.lit(1), F.char_length(text) - size + 1), lambda i: F.substring(text, i, F.lit(size)))


def gram_counts(examples: DataFrame, order: int) -> DataFrame:
    """``gram, a, b``: how often each gram of 1 to ``order`` + 1 characters stands in accepted
    and rejected examples.  The start signs count only as contexts."""
    every = F.flatten(F.array(*[grams(F.substring(F.col("_padded"), order + 1 - k, 1 << 30), k + 1) for k in range(order + 1)]))
    return (examples.select("_good", F.explode(every).alias("gram")).groupBy("gram")
            .agg(F.sum(F.col("_good").cast("long")).alias("a"), F.sum((~F.col("_good")).cast("long")).alias("b")))


def log_ratios(counts: DataFrame, needed: DataFrame, order: int) -> DataFrame:
    """``gram, delta``: log p(last character | those before) under the accepted model minus
    that under the rejected one, for the grams of ``order`` + 1 characters in ``needed``."""
    contexts = (counts.withColumn("context", F.expr("left(gram, char_length(gram) - 1)")).groupBy("context")
                .agg(F.sum("a").alias("na"), F.sum("b").alias("nb"),
                     F.sum((F.col("a") > 0).cast("long")).alias("ta"), F.sum((F.col("b") > 0).cast("long")).alias("tb")))
    below = None
    for k in range(order + 1):
        wanted = needed.select(F.expr(f"right(gram, {k + 1})").alias("gram")).distinct()
        wanted = wanted.withColumn("context", F.expr(f"left(gram, {k})")).withColumn("shorter", F.expr(f"right(gram, {k})"))
        rows = wanted.join(counts, "gram", "left").join(contexts, "context", "left").na.fill(0, ["a", "b", "na", "nb", "ta", "tb"])
        if below is None:
            rows = rows.withColumn("pa0", F.lit(1.0 / ALPHABET)).withColumn("pb0", F.lit(1.0 / ALPHABET))
        else:
            rows = rows.join(below.select(F.col("gram").alias("shorter"), F.col("pa").alias("pa0"), F.col("pb").alias("pb0")), "shorter")

        def mixed(n, of, kinds, p):
            total = F.col(of) + F.col(kinds)
            return F.when(total > 0, (F.col(n) + F.col(kinds) * F.col(p)) / total).otherwise(F.col(p))

        below = rows.select("gram", mixed("a", "na", "ta", "pa0").alias("pa"), mixed("b", "nb", "tb", "pb0").alias("pb"))
    return below.select("gram", (F.log("pa") - F.log("pb")).alias("delta"))


def calibrated_threshold(scored: DataFrame) -> DataFrame:
    """One row ``threshold``: the cut of largest balanced accuracy on the calibration rows
    (``_good, score``), 0 where a class is missing.  Scores are counted in BINS bins of
    [-5, 5), so the window below sees at most that many rows."""
    bins = (scored.select("_good", F.floor((F.least(F.greatest("score", F.lit(-5.0)), F.lit(4.999)) + 5) * (BINS / 10)).alias("bin"))
            .groupBy("bin").agg(F.sum(F.col("_good").cast("long")).alias("a"), F.sum((~F.col("_good")).cast("long")).alias("b")))
    upto, every = Window.orderBy("bin"), Window.partitionBy(F.lit(0))
    below = F.try_divide(F.sum("b").over(upto), F.sum("b").over(every))
    above = 1 - F.try_divide(F.sum("a").over(upto), F.sum("a").over(every))
    # in the middle between the bins on either side of the cut
    middle = (F.col("bin") + 1 + F.coalesce(F.lead("bin").over(upto), F.col("bin") + 1)) / 2
    rated = bins.select(middle.alias("cut"), (below + above).alias("rate"))
    best = rated.agg(F.max_by("cut", F.struct("rate", "cut")).alias("cut"), F.max("rate").alias("rate"))
    return best.select(F.when(F.col("rate").isNotNull(), F.col("cut") / (BINS / 10) - 5).otherwise(0.0).alias("threshold"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = tuple(RULES), id_col: str = "page_id",
                url_col: str = "url", *, order: int = ORDER, hot_share: float = 0.001, folds: int = 5) -> DataFrame:
    """One row per input row: ``<id_col>, host, path, rule, verdict, score, threshold``.

    A null url or one without ``://`` has an empty host and path, so no rule fits it.  The
    models see whole urls, query and fragment too (``scored_text``), however long; a null
    url is scored as the empty text.  ``score`` is null where a rule decides; of rules of equal
    length the one named last is asked first.  If the examples of a class are missing, every
    undecided URL is allowed.  Equal URLs get equal verdicts; repeated rows stay; an empty
    table gives an empty result; other columns aren't read."""
    spark = pages.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    url = F.col(f"`{url_col}`").cast("string")
    parsed = pages.select(F.col(f"`{id_col}`").alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"), scored_text(url).alias("_seen"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = kept(parsed.withColumns({"rule": rule, "_ruled": verdict, "_row": F.monotonically_increasing_id(),
                                    "_padded": F.concat(F.lit(START * order), "_seen", F.lit(STOP))}), "urls")
    example = rows.where("_ruled IS NOT NULL").withColumn("_good", F.col("_ruled") == "allow")
    unseen = F.pmod(F.xxhash64("_padded"), F.lit(folds)) == 0  # the calibration fold
    counts = kept(gram_counts(example.where(~unseen), order), "url-grams")

    asked = rows.where(F.col("_ruled").isNull() | unseen).select("_row", F.explode(grams(F.col("_padded"), order + 1)).alias("gram"))
    needed = kept(asked.groupBy("gram").agg(F.count(F.lit(1)).alias("uses")), "url-needed")
    ratios = kept(log_ratios(counts, needed, order).join(needed, "gram"), "url-ratios")
    hot = F.col("uses") >= F.greatest(F.lit(1.0), needed.agg(F.sum("uses")).scalar() * F.lit(hot_share))
    often = F.broadcast(ratios.where(hot).select("gram", F.col("delta").alias("_often")))  # at most 1 / hot_share rows
    first = asked.join(often, "gram", "left")
    rare = first.where("_often IS NULL").join(ratios.where(~hot), "gram").select("_row", "delta")
    sums = (first.where("_often IS NOT NULL").select("_row", F.col("_often").alias("delta")).unionByName(rare)
            .groupBy("_row").agg((F.sum("delta") / F.count(F.lit(1))).alias("score")))
    scored = kept(rows.join(sums, "_row", "left"), "url-scores")

    threshold = calibrated_threshold(scored.where(F.col("_ruled").isNotNull() & F.col("score").isNotNull())
                                     .withColumn("_good", F.col("_ruled") == "allow"))
    known = example.agg(F.coalesce(F.bool_or("_good") & F.bool_or(~F.col("_good")), F.lit(False)).alias("both"))
    out = scored.withColumns({"threshold": threshold.scalar(), "_both": known.scalar()})
    judged = F.when(~F.col("_both") | F.col("score").isNull() | (F.col("score") > F.col("threshold")), "allow").otherwise("block")
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("_ruled", judged).alias("verdict"),
                      F.when(F.col("_ruled").isNull(), F.col("score")).alias("score"), "threshold")
