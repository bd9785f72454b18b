"""Scores per row: strict match, task rules, keyword relevance; and their totals."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import as_column, explode_rows, ratio
from regforge.functions.text import folded, keyword_hits, shared_words, tokens
from regforge.plans.stages import staged

#: Characters by which a place of a text is looked up among keywords.
ANCHOR = 3
#: Keywords that are sent to every task.
BROADCAST_KEYWORDS = 1_000_000
STATUS_RULE = "status"
ANY_WORD_RULE = "any_word"
WORD_SHARE_RULE = "word_share"

# Rule per task; every other task uses WORD_SHARE_RULE. ANY_WORD_RULE accepts any
# reference word, stop words included, so it is available but not a default.
TASK_RULES = {C.TASK_STATUS: STATUS_RULE, C.TASK_REACTIONS: WORD_SHARE_RULE}


def task_of(task: str | Column) -> Column:
    return F.coalesce(as_column(task), F.lit(C.UNKNOWN_TASK))


def strict_match(prediction: str | Column, reference: str | Column) -> Column:
    """Equal after trim and lower case."""
    return F.coalesce(folded(prediction) == folded(reference), F.lit(False))


def with_task_score(
    df: DataFrame,
    prediction: str = "prediction",
    reference: str = "reference",
    task: str = "task",
    rules: Mapping[str, str] = TASK_RULES,
    status_words: Sequence[str] = C.STATUS_WORDS,
    name: str = "score",
) -> DataFrame:
    """Add the task score, 0 to 1. Punctuation stays part of a word."""
    lowered = df.withColumn("_p", F.lower(F.coalesce(prediction, F.lit("")))).withColumn(
        "_r", F.lower(F.coalesce(reference, F.lit("")))
    )
    words = lowered.withColumn("_ref_words", F.array_distinct(tokens("_r")))
    status = shared_words(F.col("_p"), F.col("_r"), status_words).cast("double")
    any_word = F.exists("_ref_words", lambda word: F.contains(F.col("_p"), word)).cast("double")
    shared = F.size(F.array_intersect(F.col("_ref_words"), tokens("_p")))
    share = shared.cast("double") / F.greatest(F.size("_ref_words"), F.lit(1))
    by_rule = {STATUS_RULE: status, ANY_WORD_RULE: any_word, WORD_SHARE_RULE: share}
    score = F.coalesce(*[F.when(F.col(task) == t, by_rule[rule]) for t, rule in rules.items()], share)
    return words.withColumn(name, score).select(*df.columns, name)


def with_keyword_score(
    df: DataFrame, text: str, keywords: str | Column, matches: str = "keyword_matches",
    total: str = "total_keywords", score: str = "relevance_score",
) -> DataFrame:
    """Add keyword hits, number of keywords and their ratio (0 without keywords)."""
    counted = df.withColumn(matches, keyword_hits(text, as_column(keywords))).withColumn(
        total, F.size(F.coalesce(as_column(keywords), F.array())).cast("long")
    )
    return counted.withColumn(score, ratio(F.col(matches), F.col(total)))


def suite_scores(
    df: DataFrame, sample_id: str, text: str, suite: DataFrame, keyword: str = "keyword", matches: str = "keyword_matches",
    total: str = "total_keywords", score: str = "relevance_score",
) -> DataFrame:
    """The same for a whole table of keywords against every text: ``sample_id`` (unique) and
    the three columns. A keyword that is listed twice counts twice; NULL is none.

    Every place of a text is looked up by its first characters (as many as the keyword has,
    up to ``ANCHOR``) in the table of keywords, and the candidates are compared in full, so
    the time hardly depends on the number of keywords. The pieces compared are as long as
    the longest keyword. The keywords are staged and broadcast up to a counted bound.
    """
    words = suite.filter(F.col(keyword).isNotNull()).groupBy(F.lower(keyword).alias("_word")).agg(F.count(F.lit(1)).alias("_listed"))
    words = staged(words.withColumn("_anchor", F.substring("_word", 1, ANCHOR)))
    sizes = words.agg(
        F.sum("_listed").alias("listed"), F.sum(F.when(F.col("_word") == "", F.col("_listed"))).alias("blank"),
        F.max(F.length("_word")).alias("longest"), F.collect_set(F.length("_anchor")).alias("anchors"), F.count(F.lit(1)).alias("words"),
    ).first()
    found = df.select(F.col(sample_id).alias("_sample"))
    anchors = sorted(n for n in sizes["anchors"] if n)
    if anchors:
        low = F.lower(F.coalesce(F.col(text), F.lit("")))
        # The piece at every place, in one pass over the text.
        places = F.regexp_extract_all(low, F.lit(f"(?s)(?=(.{{1,{sizes['longest']}}}))"), F.lit(1))
        pieces = explode_rows(df, places, "_piece", keep=[F.col(sample_id).alias("_sample")])
        heads = F.array(*[F.substring("_piece", 1, n) for n in anchors])
        heads = pieces.select("_sample", "_piece", F.explode(F.array_distinct(heads)).alias("_anchor"))
        listed = F.broadcast(words) if sizes["words"] <= BROADCAST_KEYWORDS else words
        hits = heads.join(listed, "_anchor").filter(F.startswith("_piece", "_word")).select("_sample", "_word", "_listed").distinct()
        found = found.join(hits.groupBy("_sample").agg(F.sum("_listed").alias("_hits")), "_sample", "left")
    else:
        found = found.withColumn("_hits", F.lit(0))
    hit = (F.coalesce("_hits", F.lit(0)) + F.lit(sizes["blank"] or 0)).cast("long")
    return found.select(F.col("_sample").alias(sample_id), hit.alias(matches), F.lit(sizes["listed"] or 0).cast("long").alias(total)).withColumn(
        score, ratio(F.col(matches), F.col(total))
    )


def score_by_task(
    df: DataFrame, score: str = "score", task: str = "task",
    prediction: str = "prediction", reference: str = "reference",
) -> DataFrame:
    """Mean score, sample count and mean lengths (in tokens) per task."""
    rows = df.select(
        task_of(task).alias("task"),
        score,
        F.size(tokens(prediction)).alias("_np"),
        F.size(tokens(reference)).alias("_nr"),
    )
    return rows.groupBy("task").agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg(score).alias("task_specific_accuracy"),
        F.avg("_np").alias("avg_pred_length"),
        F.avg("_nr").alias("avg_ref_length"),
    )


def accuracy_rollup(df: DataFrame, correct: str = "correct", task: str = "task") -> DataFrame:
    """Correct, total and ratio per task and overall (``is_total`` = 1, task NULL), from
    one aggregation. An empty table has the overall row 0 of 0."""
    rows = df.select(task_of(task).alias("task"), F.col(correct).cast("int").alias("_ok"))
    counted = [
        F.coalesce(F.sum("_ok"), F.lit(0)).cast("long").alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.avg("_ok"), F.lit(0.0)).alias("accuracy"),
    ]
    found = rows.rollup("task").agg(F.grouping("task").cast("int").alias("is_total"), *counted)
    # Only an aggregate without keys gives a row for no input; it reads one row at most.
    none = rows.limit(1).agg(*counted).filter("total = 0")
    return found.unionByName(none.select(F.lit(None).cast("string").alias("task"), F.lit(1).alias("is_total"), "correct", "total", "accuracy"))
