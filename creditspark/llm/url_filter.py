"""Operator 5: URL filter by host rules and the ratio of two character language models.

Rules judge a host with all its subdomains below a path prefix; the longest that fits wins. The URLs
that rules accept and reject are the labelled text of two variable-order Markov models of characters
(contexts of up to ``ORDER`` characters, interpolated Witten-Bell smoothing from the longest context
down to a uniform letter). A URL no rule fits is scored by the difference of its log-likelihoods under
the two, divided by its length, and let through at or above the cut. The cut is calibrated on the
labelled URLs: where both classes' scores, taken as normal, err alike.

All counts are tables of their own and grow with the input; nothing is collected. An (ORDER + 1)-gram
fixes the model's term for its last character, so terms are worked out once for each distinct gram and
joined to the distinct URLs; common grams meet in a plain join, whose skew the adaptive planner splits.

Defined results: null url, or none with ``://``: host and path empty, no rule, score 0. Null page_id and
repeated rows: judged each. No accepted or no rejected URL: no model, everything unmatched is let through.
Empty table: no rows. Columns other than page_id and url are not read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

ORDER = 4
_PAD = "\u0002"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith("host", F.lit("." + self.host))
        return host & F.startswith("path", F.lit(self.path))


RULES = (
    UrlRule("block", "net/"), UrlRule("allow", "example.net/en/"),
    UrlRule("block", "example.com/de/"), UrlRule("allow", "org/fr/"),
)


def parsed(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule (pattern or null) and label (that rule's verdict or null)."""
    part = lambda k: F.coalesce(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    host = F.translate(part(1), string.ascii_uppercase, string.ascii_lowercase)
    out = pages.select(F.col("page_id").cast("long"), host.alias("host"), part(2).alias("path"))
    longest = sorted(rules, key=lambda r: -len(r.pattern))
    rule = F.coalesce(*(F.when(r.fits(), F.lit(r.pattern)) for r in longest), F.lit(None).cast("string"))
    label = F.coalesce(*(F.when(r.fits(), F.lit(r.verdict)) for r in longest), F.lit(None).cast("string"))
    return out.withColumn("rule", rule).withColumn("label", label)


def _grams(strings: DataFrame) -> DataFrame:
    """Each string with the (ORDER + 1)-gram that ends at each of its characters and at its end."""
    padded = F.concat(F.lit(_PAD * ORDER), F.col("url"), F.lit(_PAD))
    ends = F.sequence(F.lit(1), F.char_length("url") + 1)
    return strings.select(
        "*", F.explode(F.transform(ends, lambda i: F.substring(padded, i, F.lit(ORDER + 1)))).alias("gram")
    )


def _terms(grams: DataFrame) -> DataFrame:
    """(gram, term): the log-ratio of the two models for the last character of each distinct gram."""
    counts = written(grams.groupBy("gram").agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")), "url-grams")
    model = None
    for k in range(ORDER + 1):
        gram = F.substring("gram", F.lit(ORDER + 1 - k), F.lit(k + 1))
        n = counts.groupBy(gram.alias("gram")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        n = n.withColumn("context", F.substring("gram", F.lit(1), F.lit(k)))
        total = n.groupBy("context").agg(
            F.sum("a").alias("all_a"), F.sum("r").alias("all_r"),
            F.sum((F.col("a") > 0).cast("int")).alias("kinds_a"), F.sum((F.col("r") > 0).cast("int")).alias("kinds_r"),
        )
        n = n.join(total, "context")
        if model is None:
            n = n.withColumns({"low_a": F.lit(1 / 256), "low_r": F.lit(1 / 256)})
        else:
            lower = model.select(F.col("gram").alias("shorter"), F.col("p_a").alias("low_a"), F.col("p_r").alias("low_r"))
            n = n.withColumn("shorter", F.substring("gram", F.lit(2), F.lit(k))).join(lower, "shorter")
        smooth = lambda c: F.when(
            F.col(f"all_{c}") > 0,
            (F.col(c) + F.col(f"kinds_{c}") * F.col(f"low_{c}")) / (F.col(f"all_{c}") + F.col(f"kinds_{c}")),
        ).otherwise(F.col(f"low_{c}"))
        model = written(n.select("gram", smooth("a").alias("p_a"), smooth("r").alias("p_r")), f"url-model-{k}")
    return model.select("gram", (F.log("p_a") - F.log("p_r")).alias("term"))


def _cut(good: float | None, good_spread: float, bad: float | None, bad_spread: float) -> float | None:
    """Where two normal classes err alike; None if there is no model."""
    if good is None or bad is None:
        return None
    width = good_spread + bad_spread
    return (good * bad_spread + bad * good_spread) / width if width > 0 else (good + bad) / 2


def judged(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, score, verdict) for each row of ``pages(page_id, url)``."""
    rows = parsed(pages, rules).withColumn("url", F.concat("host", "path"))
    strings = rows.groupBy("url").agg(
        F.sum((F.col("label") == "allow").cast("long")).alias("accepted"),
        F.sum((F.col("label") == "block").cast("long")).alias("rejected"),
    )
    strings = written(strings.fillna(0, ["accepted", "rejected"]), "urls")
    grams = _grams(strings.where("url <> ''"))
    scores = grams.select("url", "accepted", "rejected", "gram").join(_terms(grams), "gram")
    scores = written(scores.groupBy("url", "accepted", "rejected").agg(F.avg("term").alias("score")), "url-scores")
    sides = scores.agg(*(
        f(F.when(F.col(c) > 0, F.col("score"))).alias(f"{c}_{n}")
        for c in ("accepted", "rejected") for n, f in (("mean", F.avg), ("spread", F.stddev_pop))
    ))
    cut = _cut(*sides.select("accepted_mean", "accepted_spread", "rejected_mean", "rejected_spread").first())
    out = rows.join(scores.select("url", "score"), "url", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    by_model = F.lit("allow") if cut is None else F.when(F.col("score") >= cut, "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", "score", F.coalesce("label", by_model).alias("verdict"))
