"""Text metrics of predictions against references.

Each ``with_*`` operator adds row-level columns without a shuffle; each ``*_summary``
reduces them to one row (or one row per group) with a map-side combined aggregation.
Predictions and references arrive paired in one row; ``paired`` makes that pairing by key,
``paired_by_position`` by the order of the rows in their files.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import explode_rows, harmonic_mean, ratio
from regforge.functions.multiset import multiset_overlap, ngram_count, ngrams
from regforge.functions.subsequence import subsequence_counts
from regforge.functions.text import (
    alphanumeric_tokens,
    normalized,
    structure_candidates,
    tokens,
    word_tokens,
)
from regforge.functions.vectors import cosine
from regforge.operators.joins import splittable_join
from regforge.operators.scoring import task_of
from regforge.plans.stages import staged
from regforge.sources.positions import numbered_rows

BLEU_ORDERS = (1, 2, 3, 4)


def paired(predictions: DataFrame, references: DataFrame, sample_id: str | Sequence[str]) -> DataFrame:
    """Predictions and references of the same sample, by key instead of by position."""
    return predictions.join(references, sample_id)


def paired_by_position(predictions: DataFrame, references: DataFrame, number: str = "row_number", how: str = "inner") -> DataFrame:
    """Predictions and references without a common key, both straight from a reader: the
    n-th row of one belongs to the n-th of the other. The longer table's rest has no
    partner; ``how='left'`` keeps the predictions of it. Numbering runs jobs."""
    return numbered_rows(predictions, number).join(numbered_rows(references, number), number, how)


# --- exact match -----------------------------------------------------------------
def with_exact_match(df: DataFrame, prediction: str = "prediction", reference: str = "reference",
                     name: str = "exact_match") -> DataFrame:
    same = normalized(F.coalesce(prediction, F.lit(""))) == normalized(F.coalesce(reference, F.lit("")))
    return df.withColumn(name, same)


def exact_match_summary(df: DataFrame, flag: str = "exact_match") -> DataFrame:
    return df.agg(
        F.coalesce(F.avg(F.col(flag).cast("int")), F.lit(0.0)).alias("exact_match"),
        F.count_if(flag).alias("exact_match_count"),
    )


# --- word precision, recall, F1 --------------------------------------------------
def with_word_f1(df: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Add ``word_precision``, ``word_recall``, ``word_f1`` on token sets."""
    sets = df.withColumn("_p", F.array_distinct(word_tokens(prediction))).withColumn(
        "_r", F.array_distinct(word_tokens(reference))
    )
    sizes = sets.withColumn("_common", F.size(F.array_intersect("_p", "_r"))).withColumns(
        {"_np": F.size("_p"), "_nr": F.size("_r")}
    )
    scored = sizes.withColumn("word_precision", ratio(F.col("_common"), F.col("_np"))).withColumn(
        "word_recall", ratio(F.col("_common"), F.col("_nr"))
    )
    scored = scored.withColumn("word_f1", harmonic_mean(F.col("word_precision"), F.col("word_recall")))
    return scored.select(*df.columns, "word_precision", "word_recall", "word_f1")


def word_f1_summary(df: DataFrame) -> DataFrame:
    return df.agg(*[F.avg(name).alias(name) for name in ("word_f1", "word_precision", "word_recall")])


def word_f1_by_task(df: DataFrame, task: str = "task") -> DataFrame:
    return df.groupBy(task_of(task).alias("task")).agg(
        F.avg("word_f1").alias("f1"), F.count(F.lit(1)).alias("count")
    )


# --- lengths ---------------------------------------------------------------------
def with_lengths(df: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Add ``pred_length`` and ``ref_length`` in whitespace tokens and their ratio."""
    return df.withColumns(
        {
            "pred_length": F.size(tokens(prediction)).cast("long"),
            "ref_length": F.size(tokens(reference)).cast("long"),
        }
    ).withColumn("length_ratio", ratio(F.col("pred_length"), F.col("ref_length")))


def length_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg("pred_length").alias("avg_pred_length"),
        F.avg("ref_length").alias("avg_ref_length"),
        F.avg("length_ratio").alias("length_ratio"),
        F.stddev_pop("pred_length").alias("length_std"),
    )


# --- BLEU ------------------------------------------------------------------------
def with_bleu_counts(df: DataFrame, prediction: str = "prediction", reference: str = "reference",
                     orders: Sequence[int] = BLEU_ORDERS) -> DataFrame:
    """Add clipped n-gram matches and possible matches per order, and both lengths."""
    words = df.withColumn("_p", tokens(prediction)).withColumn("_r", tokens(reference))
    matches = {f"match_{n}": multiset_overlap(ngrams(F.col("_p"), n), ngrams(F.col("_r"), n)) for n in orders}
    possible = {f"possible_{n}": ngram_count(F.col("_p"), n) for n in orders}
    lengths = {"pred_tokens": F.size("_p").cast("long"), "ref_tokens": F.size("_r").cast("long")}
    return words.withColumns({**matches, **possible, **lengths}).drop("_p", "_r")


def with_bleu(totals: DataFrame, orders: Sequence[int] = BLEU_ORDERS) -> DataFrame:
    """Add ``bleu_n`` precisions and ``bleu`` to summed counts: brevity penalty, no
    smoothing, 0 if any precision is 0."""
    precision = totals.withColumns(
        {f"bleu_{n}": ratio(F.col(f"match_{n}"), F.col(f"possible_{n}")) for n in orders}
    )
    logs = [F.ln(F.col(f"bleu_{n}")) for n in orders]
    mean_log = sum(logs[1:], logs[0]) / len(orders)
    pred, ref = F.col("pred_tokens").cast("double"), F.col("ref_tokens").cast("double")
    penalty = F.when(pred > ref, F.lit(1.0)).otherwise(F.exp(F.lit(1.0) - F.try_divide(ref, pred)))
    some_zero = F.least(*[F.col(f"bleu_{n}") for n in orders]) <= 0
    return precision.withColumn("bleu", F.when(some_zero, F.lit(0.0)).otherwise(penalty * F.exp(mean_log)))


def bleu_summary(df: DataFrame, orders: Sequence[int] = BLEU_ORDERS, by: Sequence[str] = ()) -> DataFrame:
    """Corpus BLEU over all rows, or per group."""
    sums = [f"match_{n}" for n in orders] + [f"possible_{n}" for n in orders] + ["pred_tokens", "ref_tokens"]
    return with_bleu(df.groupBy(*by).agg(*[F.sum(name).alias(name) for name in sums]), orders)


# --- ROUGE -----------------------------------------------------------------------
def with_rouge_n(df: DataFrame, prediction: str = "prediction", reference: str = "reference",
                 orders: Sequence[int] = (1, 2)) -> DataFrame:
    """Add ``rouge1``, ``rouge2``: F-measure of the n-gram multiset overlap per row."""
    words = df.withColumn("_p", alphanumeric_tokens(prediction)).withColumn(
        "_r", alphanumeric_tokens(reference)
    )
    overlaps = words.withColumns(
        {f"_o{n}": multiset_overlap(ngrams(F.col("_p"), n), ngrams(F.col("_r"), n)) for n in orders}
    )
    scores = {
        f"rouge{n}": harmonic_mean(
            ratio(F.col(f"_o{n}"), ngram_count(F.col("_p"), n)),
            ratio(F.col(f"_o{n}"), ngram_count(F.col("_r"), n)),
        )
        for n in orders
    }
    return overlaps.withColumns(scores).select(*df.columns, *scores)


def with_rouge_l(df: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Add ``rougeL`` and ``rougeLsum`` from whole texts, without a token cap."""
    counted = df.withColumn("_s", subsequence_counts(prediction, reference))

    def measure(hits: str) -> Column:
        return harmonic_mean(
            ratio(F.col(hits), F.col("_s.prediction_tokens")),
            ratio(F.col(hits), F.col("_s.reference_tokens")),
        )

    return counted.withColumn("rougeL", measure("_s.lcs")).withColumn(
        "rougeLsum", measure("_s.line_hits")
    ).drop("_s")


def mean_summary(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(name).alias(name) for name in names])


# --- vectors ---------------------------------------------------------------------
def with_cosine(df: DataFrame, prediction: str = "prediction_vector", reference: str = "reference_vector",
                name: str = "similarity") -> DataFrame:
    return df.withColumn(name, cosine(prediction, reference))


def text_cosine(df: DataFrame, sample_id: str, prediction: str = "prediction", reference: str = "reference", name: str = "similarity") -> DataFrame:
    """``sample_id`` and the cosine of the weighted words of both texts, without vectors given.

    A word weighs its count in the text times ``ln((1 + texts) / (1 + texts with it)) + 1``,
    over all predictions and references. Word counts per sample are staged (a job). The
    frequencies meet them in a join that is broadcast by Spark's own size check, or splits a
    word that nearly every text has; products are summed up per sample, map-side first. A
    text without words is like nothing: 0.
    """
    sides = F.array(*[F.struct(F.lit(i).alias("side"), word_tokens(c).alias("words")) for i, c in enumerate((prediction, reference))])
    parts = df.select(F.col(sample_id).alias("_id"), F.inline(sides))
    words = explode_rows(parts, "words", "_word", keep=["_id", "side"])
    counts = words.groupBy("_id", "_word").agg(*[F.count_if(F.col("side") == i).alias(n) for i, n in enumerate("pr")])
    counts = staged(counts)
    held = counts.groupBy("_word").agg(F.sum((F.col("p") > 0).cast("int") + (F.col("r") > 0).cast("int")).alias("_held"))
    weighted = splittable_join(counts, held, "_word", "_word", "inner")
    weight = F.log((1 + F.lit(2 * df.count())) / (1 + F.col("_held"))) + 1
    p, r = (F.col(n) * weight for n in "pr")
    sums = weighted.groupBy("_id").agg(F.sum(p * r).alias("_pr"), F.sum(p * p).alias("_pp"), F.sum(r * r).alias("_rr"))
    found = df.select(F.col(sample_id).alias("_sample")).join(sums, F.col("_sample") == F.col("_id"), "left")
    return found.select(F.col("_sample").alias(sample_id), ratio(F.col("_pr"), F.sqrt(F.col("_pp")) * F.sqrt(F.col("_rr"))).alias(name))


def cosine_summary(df: DataFrame, similarity: str = "similarity") -> DataFrame:
    return df.agg(
        F.avg(similarity).alias("semantic_similarity"),
        F.stddev_pop(similarity).alias("semantic_similarity_std"),
        F.min(similarity).alias("semantic_similarity_min"),
        F.max(similarity).alias("semantic_similarity_max"),
    )


# --- structures inside text ------------------------------------------------------
def candidate_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct structure candidates with their occurrences per text column (``in_<column>``).

    One pass over the rows for all columns. Combines map-side, so a candidate that is
    everywhere costs one row per task.
    """
    lists = F.array(*[structure_candidates(F.col(column)) for column in columns])
    sides = explode_rows(df, lists, "_found", position="_side")
    found = explode_rows(sides, "_found", "candidate", ["_side"])
    return found.groupBy("candidate").agg(
        *[F.count_if(F.col("_side") == i).alias(f"in_{column}") for i, column in enumerate(columns)]
    )


def known_structure_rate(
    df: DataFrame,
    dictionary: DataFrame,
    structure: str = "canonical_smiles",
    prediction: str = "prediction",
    reference: str | None = "reference",
) -> DataFrame:
    """Share of the candidates in predictions that the dictionary knows, how many those
    are, and the same count for references; NULL rate if there are no candidates."""
    known = (
        dictionary.select(F.col(structure).alias("candidate"))
        .filter(F.col("candidate").isNotNull())
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    columns = [prediction] if reference is None else [prediction, reference]
    marked = candidate_counts(df, columns).join(known, "candidate", "left")

    def total(column: str | None, only_known: bool) -> Column:
        if column is None:
            return F.lit(0).cast("long")
        occurrences = F.col(f"in_{column}")
        counted = F.when(F.col("_known"), occurrences) if only_known else occurrences
        return F.coalesce(F.sum(counted), F.lit(0))

    counts = marked.agg(
        total(prediction, False).alias("candidates"),
        total(prediction, True).alias("valid_smiles_count"),
        total(reference, True).alias("reference_smiles_count"),
    )
    rate = F.try_divide(F.col("valid_smiles_count").cast("double"), F.col("candidates"))
    return counts.withColumn("smiles_validity_rate", rate)


# --- report form -----------------------------------------------------------------
def metric_rank(metric: str | Column, priority: Sequence[str] = C.METRIC_PRIORITY) -> Column:
    """Place of a metric in a report: priority metrics first, all others after them."""
    metric = F.lit(metric) if isinstance(metric, str) else metric
    places = [F.when(metric == name, F.lit(i)) for i, name in enumerate(priority, start=1)]
    return F.coalesce(*places, F.lit(len(priority) + 1))


def to_long(df: DataFrame, priority: Sequence[str] = C.METRIC_PRIORITY) -> DataFrame:
    """Wide metric row to ``(metric, value, rank)``; metrics without a value disappear."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.col(name).cast("double").alias("value"),
                metric_rank(name, priority).alias("rank"),
            )
            for name in df.columns
        ]
    )
    return df.select(F.inline(rows)).filter(F.col("value").isNotNull())
