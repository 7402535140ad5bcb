"""URL filter by the likelihood ratio of two character models (operator 8).

Host rules accept or reject what they fit.  The URLs they accept train one
variable-order Markov model, those they reject another: the probability of a
character behind its last ``ORDER`` characters is interpolated from that of
shorter contexts (Witten-Bell).  A URL without a rule is judged by the mean
log-likelihood difference a character against a threshold calibrated on
labelled pages that the models have not seen.

DataFrame functions only: counts and probabilities are tables keyed by n-gram,
built order by order, and joined to the n-grams of the URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurejudge.llm.common import cut_lineage, held_out, lower_ascii

#: (verdict, host and path) in the notation of the contract.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
ORDER = 4                 # longest context
ALPHABET = 256.0          # characters that the shortest model takes as equally likely
HELD_OUT = (5, 0)         # labelled pages kept from the models for calibration: crc32(page_id) % 5 = 0


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.coalesce(lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES, verdicts: bool = False) -> Column:
    """The longest rule that fits (its verdict if ``verdicts``), else null."""
    out = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(verdict if verdicts else rule)).otherwise(out)
    return out


def grams(rows: DataFrame, *carry: str) -> DataFrame:
    """(carry..., gram): every character of host and path with the ``ORDER`` before
    it.  Digits are read as one, so a model learns no page numbers."""
    text = F.concat(F.lit("^" * ORDER), F.translate(F.concat("host", F.lower("path")), "123456789", "000000000"), F.lit("$"))
    return (rows.withColumn("chars", text)
            .select(*carry, "chars", F.explode(F.sequence(F.lit(1), F.length("chars") - ORDER)).alias("at"))
            .select(*carry, F.substring("chars", F.col("at"), F.lit(ORDER + 1)).alias("gram")))


def probabilities(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, diff) for the longest n-grams: log-probability of the last
    character under the accepted model less that under the rejected one.
    ``counted``: (gram, allow, block), one row a distinct n-gram, counts of
    learning rows (n-grams of other rows with zero counts)."""
    shorter = None
    for k in range(order + 1):
        seen = cut_lineage(counted.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("g"))
                           .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
        context = cut_lineage(seen.groupBy(F.substring("g", 1, k).alias("c")).agg(
            *[F.sum(x).alias(f"{x}_n") for x in ("allow", "block")],
            *[F.count_if(F.col(x) > 0).alias(f"{x}_kinds") for x in ("allow", "block")]))
        rows = seen.join(context, F.substring("g", 1, k) == F.col("c"))
        if shorter is None:
            rows = rows.withColumns({f"{x}_p0": F.lit(1 / ALPHABET) for x in ("allow", "block")})
        else:
            rows = rows.join(shorter, F.substring("g", 2, k) == F.col("s"))
        def share(x):
            mass = F.col(f"{x}_n") + F.col(f"{x}_kinds")
            return F.when(mass > 0, (F.col(x) + F.col(f"{x}_kinds") * F.col(f"{x}_p0")) / mass).otherwise(F.col(f"{x}_p0"))
        shorter = cut_lineage(rows.select(F.col("g").alias("s"), *[share(x).alias(f"{x}_p0") for x in ("allow", "block")]))
    return shorter.select(F.col("s").alias("gram"), (F.log("allow_p0") - F.log("block_p0")).alias("diff"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row a row of ``pages``
    (page_id, url; other columns are ignored).

    ``score`` is the mean log-likelihood difference a character.  URLs without
    a host have only the end mark to score and are judged by it; where the
    rules accept or reject no page, the models say nothing and URLs without a
    rule are allowed.  Repeated rows are judged alike and count each; rows
    without an id are learned from and never held out."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = cut_lineage(rows.withColumns({"rule": rule_of(F.col("host"), F.col("path"), rules),
                                         "ruled": rule_of(F.col("host"), F.col("path"), rules, verdicts=True)})
                       .withColumn("fold", F.when(F.col("ruled").isNull(), "new")
                                   .when(held_out(F.col("page_id"), *HELD_OUT), "calibrate").otherwise("learn"))
                       .withColumn("row", F.monotonically_increasing_id()))
    # equal hosts and paths have equal n-grams: one scored row for each, with its weights
    urls = cut_lineage(rows.groupBy("host", "path").agg(
        F.min("row").alias("row"), *[F.count_if((F.col("fold") == "learn") & (F.col("ruled") == x)).alias(x) for x in ("allow", "block")]))
    counted = cut_lineage(grams(urls, "allow", "block").groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
    diffs = probabilities(counted)
    scores = (grams(urls, "row").join(diffs, "gram").groupBy("row").agg(F.sum("diff").alias("total"), F.count("*").alias("n"))
              .select("row", (F.col("total") / F.col("n")).alias("score")))
    scored = cut_lineage(urls.select("row", F.col("host").alias("h"), F.col("path").alias("p")).join(scores, "row").drop("row"))
    out = cut_lineage(rows.join(scored, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left"))
    limit = threshold(out)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= F.lit(limit), "allow").otherwise("block") if limit is not None else F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.round("score", 6).alias("score"))


def threshold(scored: DataFrame) -> float | None:
    """The score that is as many deviations above the rejected mean as below
    the accepted one, over calibration rows (over all labelled rows where a
    side has none); None if a side has no labelled row at all."""
    for folds in (("calibrate",), ("calibrate", "learn")):
        side = {r["ruled"]: (r["mean"], max(r["deviation"] or 0.0, 1e-6)) for r in
                scored.where(F.col("fold").isin(*folds) & F.col("score").isNotNull()).groupBy("ruled")
                .agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("deviation")).collect()}
        if {"allow", "block"} <= side.keys():
            (a, da), (b, db) = side["allow"], side["block"]
            return (a * db + b * da) / (da + db)
    return None
