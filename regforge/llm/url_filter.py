"""URL filter: rules, then the ratio of two character language models, in DataFrames.

The models are smoothed Markov models of variable order over host and path, one of
accepted and one of rejected URLs. A context of up to ``ORDER - 1`` characters that has been
seen n times with t different successors gives (count + t * lower) / (n + t), where lower
is the probability in the next shorter context; an unseen context passes the shorter one on.
A URL's score is the mean over its characters and its end of the difference of the
log-probabilities. A fifth of the examples, by hash, is kept from the counts; the threshold
is the score with the least sum of error rates on it.

Grams are counted and scored once per distinct gram; frequent ones leave each task as one
row. A null URL, and one without ``://``, has an empty host and path, and is scored as an
empty text. Without examples of both kinds every URL passes. Repeated rows are judged
alike; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regforge.functions.columns import bind, explode_rows
from regforge.llm.common import staged

ORDER = 5
START, END = "\x02", "\x03"
#: Characters a model gives equal chances to when it has seen nothing.
ALPHABET = 128.0
BIN = 0.01
#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruling(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, else NULLs. ``rules`` is a short list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(domain + start)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def grams(text: Column, order: int = ORDER) -> Column:
    """One gram per character and one for the end: the character after its context."""
    padded = F.concat(F.lit(START * (order - 1)), text, F.lit(END))
    return bind(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - order + 1), lambda i: F.substring(p, i, F.lit(order))))


def gram_counts(examples: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, yes, no): counts in accepted and in rejected texts (``text``, ``accepted``)."""
    rows = explode_rows(examples, grams(F.col("text"), order), "gram", keep=["accepted"])
    return rows.groupBy("gram").agg(F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no"))


def gram_scores(wanted: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, gain): log-probability as accepted minus as rejected, for distinct grams."""
    out = wanted.select("gram", F.lit(1 / ALPHABET).alias("p_yes"), F.lit(1 / ALPHABET).alias("p_no"))
    for k in range(1, order + 1):
        here = counts.groupBy(F.right("gram", F.lit(k)).alias("short")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        context = here.groupBy(F.left("short", F.lit(k - 1)).alias("context")).agg(
            *[F.sum(c).alias("n_" + c) for c in ("yes", "no")], *[F.count(F.when(F.col(c) > 0, 1)).alias("t_" + c) for c in ("yes", "no")]
        )
        out = out.withColumn("short", F.right("gram", F.lit(k))).withColumn("context", F.left("short", F.lit(k - 1)))
        out = out.join(here, "short", "left").join(context, "context", "left")
        for c in ("yes", "no"):
            n, t = F.coalesce("n_" + c, F.lit(0)), F.coalesce("t_" + c, F.lit(0))
            seen = (F.coalesce(c, F.lit(0)) + t * F.col("p_" + c)) / (n + t)
            out = out.withColumn("p_" + c, F.when(n > 0, seen).otherwise(F.col("p_" + c)))
        out = out.select("gram", "p_yes", "p_no")
    return out.select("gram", (F.log("p_yes") - F.log("p_no")).alias("gain"))


def threshold(scores: DataFrame) -> float | None:
    """The cut with the least sum of error rates over (score, accepted), from a histogram."""
    counts = scores.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no")
    )
    # One row per bin: scores are differences of log-probabilities with a floor, so bins are few.
    everything = Window.partitionBy(F.lit(0))
    upto = everything.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    wrong = F.coalesce(F.sum("yes").over(upto), F.lit(0)) / F.sum("yes").over(everything) + 1 - F.coalesce(F.sum("no").over(upto), F.lit(0)) / F.sum("no").over(everything)
    best = counts.withColumn("wrong", wrong).filter("wrong is not null").orderBy("wrong", "bin").select("bin").limit(1).collect()
    return best[0]["bin"] * BIN if best else None


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, examples: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row.

    ``examples`` (url, accepted) train the models; by default the URLs that a rule judges do.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = ruling(F.col("host"), F.col("path"), rules)
    rows = staged(rows.select("*", rule.alias("rule"), verdict.alias("ruled"), F.concat("host", "path").alias("text")), "urls")
    if examples is None:
        known = rows.filter("rule is not null").select("text", (F.col("ruled") == "allow").alias("accepted"))
    else:
        known = examples.filter("accepted is not null").select(F.concat(*host_and_path(F.col("url").cast("string"))).alias("text"), "accepted")
    kept = F.pmod(F.xxhash64("text", F.lit("calibration")), F.lit(5)) == 0
    counts = staged(gram_counts(known.filter(~kept)), "url-counts")
    texts = rows.select("text").union(known.filter(kept).select("text")).distinct()
    places = explode_rows(texts, grams(F.col("text")), "gram", keep=["text"])
    gains = staged(gram_scores(places.select("gram").distinct(), counts), "url-grams")
    scores = staged(places.join(gains, "gram").groupBy("text").agg(F.avg("gain").alias("score")), "url-scores")
    cut = threshold(known.filter(kept).join(scores, "text"))
    passes = F.col("score") >= F.lit(cut) if cut is not None else F.lit(True)
    judged = rows.join(scores, "text")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(passes, "allow").otherwise("block")).alias("verdict"), "score")
