"""All metrics of one set of predictions."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge.operators import metrics as M
from regforge.operators.scoring import task_of, with_task_score

_SUMS = [f"{kind}_{n}" for kind in ("match", "possible") for n in M.BLEU_ORDERS] + ["pred_tokens", "ref_tokens"]


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in _SUMS]


def _with_bleu(totals: DataFrame, orders: int = 2) -> DataFrame:
    unused = [f"bleu_{n}" for n in M.BLEU_ORDERS if n > orders]
    return M.with_bleu(totals).drop(*_SUMS, *unused)


_STEPS = (M.with_exact_match, M.with_word_f1, M.with_lengths, M.with_bleu_counts, M.with_rouge_n, M.with_rouge_l)


def _metric_columns() -> list[Column]:
    """The aggregates of all row-level scores."""
    means = {name: name for name in ("word_f1", "word_precision", "word_recall", "length_ratio",
                                     "rouge1", "rouge2", "rougeL", "rougeLsum")}
    means |= {"avg_pred_length": "pred_length", "avg_ref_length": "ref_length"}
    return [
        F.coalesce(F.avg(F.col("exact_match").cast("int")), F.lit(0.0)).alias("exact_match"),
        F.count_if("exact_match").alias("exact_match_count"),
        *[F.avg(column).alias(name) for name, column in means.items()],
        F.stddev_pop("pred_length").alias("length_std"),
        *_sums(),
    ]


def all_metrics(
    df: DataFrame, prediction: str = "prediction", reference: str = "reference"
) -> DataFrame:
    """One wide row. All row-level scores are added in one pass over the pairs (no
    shuffle), then reduced by a single aggregation."""
    rows = df.select(F.col(prediction).alias("prediction"), F.col(reference).alias("reference"))
    rows = reduce(lambda table, step: step(table), _STEPS, rows)
    return _with_bleu(rows.agg(*_metric_columns()))


def _text_metrics_by_task(df: DataFrame, prediction: str, reference: str, task: str) -> DataFrame:
    """The text metrics of all rows, and ``<task>_f1`` and ``<task>_count``, as
    ``(metric, value, rank)``: one pass over the pairs and one rollup."""
    rows = df.select(
        F.col(prediction).alias("prediction"), F.col(reference).alias("reference"), task_of(task).alias("task")
    )
    rows = reduce(lambda table, step: step(table), _STEPS, rows)
    totals = rows.rollup("task").agg(F.grouping("task").alias("_total"), F.count(F.lit(1)).alias("_rows"), *_metric_columns())
    totals = _with_bleu(totals)
    names = [name for name in totals.columns if name not in ("task", "_total", "_rows")]

    def entry(name: Column, value: Column) -> Column:
        return F.struct(name.alias("metric"), value.cast("double").alias("value"))

    overall = F.array(*[entry(F.lit(name), F.col(name)) for name in names])
    one_task = F.array(
        entry(F.concat("task", F.lit("_f1")), F.col("word_f1")), entry(F.concat("task", F.lit("_count")), F.col("_rows"))
    )
    found = totals.select(F.inline(F.when(F.col("_total") == 1, overall).otherwise(one_task)))
    return found.filter(F.col("value").isNotNull()).withColumn("rank", M.metric_rank(F.col("metric")))


def metric_report(
    df: DataFrame,
    prediction: str = "prediction",
    reference: str = "reference",
    task: str | None = None,
    structures: DataFrame | None = None,
    structure: str = "canonical_smiles",
    vectors: tuple[str, str] | None = None,
) -> DataFrame:
    """``(metric, value, rank)`` for everything that can be computed from what is given:
    the text metrics always, ``<task>_f1`` and ``<task>_count`` with a task column, the
    known-structure rate with a structure dictionary, the similarity with two vector
    columns."""
    if task is None:
        parts = [M.to_long(all_metrics(df, prediction, reference))]
    else:
        parts = [_text_metrics_by_task(df, prediction, reference, task)]
    if vectors is not None:
        similar = M.with_cosine(df, *vectors)
        parts.append(M.to_long(M.cosine_summary(similar)))
    if structures is not None:
        rate = M.known_structure_rate(df, structures, structure, prediction, reference)
        found = rate.filter("valid_smiles_count > 0").drop("candidates")
        parts.append(M.to_long(found))
    return reduce(DataFrame.unionByName, parts)


def evaluation_by_task(
    df: DataFrame, prediction: str = "prediction", reference: str = "reference", task: str = "task",
    **score_options,
) -> DataFrame:
    """The evaluation table: per task and overall (``is_total`` = 1) the mean task score,
    corpus BLEU, mean ROUGE, mean lengths and the number of samples.

    Row-level columns in one pass, then one rollup: the overall row is not a second
    evaluation.
    """
    rows = df.select(
        F.col(prediction).alias("prediction"),
        F.col(reference).alias("reference"),
        task_of(task).alias("task"),
    )
    rows = with_task_score(rows, **score_options)
    steps = (M.with_bleu_counts, M.with_rouge_n, M.with_rouge_l)
    rows = reduce(lambda table, step: step(table), steps, rows)
    totals = rows.rollup("task").agg(
        F.grouping("task").cast("int").alias("is_total"),
        F.count(F.lit(1)).alias("samples"),
        F.avg("score").alias("task_specific_accuracy"),
        *[F.avg(name).alias(name) for name in ("rouge1", "rouge2", "rougeL", "rougeLsum")],
        F.avg("pred_tokens").alias("avg_pred_length"),
        F.avg("ref_tokens").alias("avg_ref_length"),
        *_sums(),
    )
    return _with_bleu(totals, orders=0)
