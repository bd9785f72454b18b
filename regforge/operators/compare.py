"""Two models side by side on the same prompts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import ratio
from regforge.functions.text import excerpt
from regforge.operators.scoring import with_keyword_score

BASE, TUNED = "base", "finetuned"


def scored_responses(
    responses: DataFrame, suite: DataFrame | None = None, prompt: str = "prompt_id",
    text: str = "response", keywords: str = "expected_keywords",
) -> DataFrame:
    """Keyword scores per (prompt, model). ``suite`` brings the keywords per prompt,
    unless the responses carry them. A prompt that the suite lacks has no keywords: 0 of 0."""
    rows = responses if suite is None else responses.join(suite, prompt, "left")
    return with_keyword_score(rows, text, keywords)


def _of(model: str, value: str, model_column: str) -> Column:
    return F.max(F.when(F.col(model_column) == model, F.col(value)))


def winners(
    scored: DataFrame, prompt: str = "prompt_id", task: str = "task", model: str = "model",
    base: str = BASE, tuned: str = TUNED,
) -> DataFrame:
    """Scores of both models per prompt and the winner: ``Tie`` if equal, NULL where one
    of the models has no response.

    A conditional aggregate over the two known models: no self-join, doubles only in
    the buffer.
    """
    sides = scored.groupBy(prompt, task).agg(
        _of(base, "relevance_score", model).alias("base_score"),
        _of(tuned, "relevance_score", model).alias("tuned_score"),
    )
    winner = F.when(F.col("tuned_score") > F.col("base_score"), tuned).when(
        F.col("base_score") > F.col("tuned_score"), base
    ).when(F.col("base_score") == F.col("tuned_score"), "Tie")
    return sides.withColumn("winner", winner)


def comparison_summary(
    scored: DataFrame, model: str = "model", base: str = BASE, tuned: str = TUNED
) -> DataFrame:
    """Totals of both models, relative improvements and the verdict, in one row."""

    def mean(name: str, which: str) -> Column:
        return F.avg(F.when(F.col(model) == which, F.col(name)))

    def total(name: str, which: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(model) == which, F.col(name))), F.lit(0)).cast("long")

    sums = scored.agg(
        mean("relevance_score", base).alias("base_relevance"),
        mean("relevance_score", tuned).alias("finetuned_relevance"),
        mean("latency", base).alias("base_latency"),
        mean("latency", tuned).alias("finetuned_latency"),
        total("keyword_matches", base).alias("base_matches"),
        total("keyword_matches", tuned).alias("finetuned_matches"),
        total("total_keywords", base).alias("total_keywords"),
    )

    def gain(after: str, before: str, floor: float | None = None) -> Column:
        old = F.col(before).cast("double")
        scale = old if floor is None else F.greatest(old, F.lit(floor))
        return F.try_divide(F.col(after) - old, scale) * 100

    relevance = F.col("finetuned_relevance") - F.col("base_relevance")
    verdict = F.when(relevance > 0, "better").when(relevance == 0, "similar").when(relevance < 0, "worse")
    return sums.withColumns(
        {
            "improvement_percent": gain("finetuned_relevance", "base_relevance", 0.01),
            "matches_percent": gain("finetuned_matches", "base_matches", 1.0),
            "latency_percent": gain("finetuned_latency", "base_latency"),
            "base_keyword_accuracy": ratio(F.col("base_matches"), F.col("total_keywords")),
            "finetuned_keyword_accuracy": ratio(F.col("finetuned_matches"), F.col("total_keywords")),
            "verdict": verdict,
        }
    )


def sample_responses(
    scored: DataFrame, prompt: str = "prompt_id", text: str = "response", model: str = "model",
    prompts: int = C.SAMPLE_PROMPTS, characters: int = C.SAMPLE_CHARACTERS,
    base: str = BASE, tuned: str = TUNED, shown: Sequence[str] = (),
) -> DataFrame:
    """Report of the first prompts with both responses, long ones cut for display.

    ``shown`` names text columns of the prompt (instruction, input) to print, cut alike.

    The prompts are picked first (top-k on the key alone), then only their texts are
    brought together.
    """
    first = scored.select(prompt).distinct().orderBy(prompt).limit(prompts)
    # At most ``prompts`` rows, hence the broadcast: texts of other prompts stay put.
    rows = scored.join(F.broadcast(first), prompt, "left_semi")
    return rows.groupBy(prompt).agg(
        *[F.max(excerpt(column, characters)).alias(column) for column in shown],
        *[
            F.max(F.when(F.col(model) == which, value)).alias(f"{label}_{name}")
            for which, label in ((base, "base"), (tuned, "tuned"))
            for name, value in (
                ("response", excerpt(text, characters)),
                ("score", F.col("relevance_score")),
                ("latency", F.col("latency")),
            )
        ]
    )
