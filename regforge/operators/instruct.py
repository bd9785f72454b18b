"""Instruction rows and the labelled classification table."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import as_column, blank_to_null, fill
from regforge.functions.text import NON_WHITESPACE, WHITESPACE, stripped, tokens


def _row(instruction: Column, input_text: Column, output: Column, task: str) -> Column:
    return F.struct(
        instruction.alias("instruction"),
        input_text.alias("input"),
        output.alias("output"),
        F.lit(task).alias("task"),
    )


def instruction_rows(
    df: DataFrame,
    name: str = "drug_name",
    status: str = "status",
    structure: str = "canonical_smiles",
    reactions: str = "adverse_reactions",
    reason: str = "failure_reason",
    approved: Sequence[str] = C.APPROVED_STATUSES,
    stopped: Sequence[str] = C.STOPPED_STATUSES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Up to five question rows per entity, from a single pass (no union, no shuffle).

    Absent optional columns count as missing. ``keep`` carries columns along, e.g. the
    name as split key.
    """

    def optional(column: str) -> Column:
        return blank_to_null(column) if column in df.columns else F.lit(None).cast("string")

    values = {"name": F.col("_name"), "status": F.col("_status"), "reason": F.col("_reason"),
              "structure": F.col("_structure"), "reactions": F.col("_reactions")}
    facts = df.select(
        *keep,
        blank_to_null(name).alias("_name"),
        optional(status).alias("_status"),
        optional(structure).alias("_structure"),
        optional(reactions).alias("_reactions"),
        optional(reason).alias("_reason"),
    ).filter((stripped("_name") != "") & (F.col("_name") != C.UNKNOWN_NAME))

    def text(template: str, **other: Column) -> Column:
        return fill(template, **{**values, **other})

    subject = text(C.SUBJECT_INPUT)
    with_structure = F.concat(subject, F.coalesce(text(C.STRUCTURE_LINE), F.lit("")))
    known_reason = F.coalesce(values["reason"], F.lit(C.UNKNOWN_REASON))
    has_structure = values["structure"].isNotNull()
    rows = [
        F.when(
            values["status"].isin(*approved),
            _row(text(C.APPROVED_QUESTION), with_structure, text(C.APPROVED_ANSWER), C.TASK_STATUS),
        ).when(
            values["status"].isin(*stopped),
            _row(text(C.STOPPED_QUESTION), with_structure,
                 text(C.STOPPED_ANSWER, reason=known_reason), C.TASK_STATUS),
        ),
        F.when(
            values["reactions"].isNotNull(),
            _row(text(C.REACTIONS_QUESTION), subject, text(C.REACTIONS_ANSWER), C.TASK_REACTIONS),
        ),
        F.when(
            has_structure,
            _row(text(C.STRUCTURE_QUESTION), subject, text(C.STRUCTURE_ANSWER), C.TASK_STRUCTURE),
        ),
        F.when(
            has_structure,
            _row(F.lit(C.IDENTIFY_QUESTION), text(C.STRUCTURE_INPUT), text(C.IDENTIFY_ANSWER),
                 C.TASK_IDENTIFY),
        ),
        F.when(
            stripped(values["reason"]) != "",
            _row(text(C.FAILURE_QUESTION), with_structure, text(C.FAILURE_ANSWER), C.TASK_FAILURE),
        ),
    ]
    # A NULL element is a question the entity does not have.
    exploded = facts.select(*keep, F.explode(F.array(*rows)).alias("_row"))
    return exploded.filter(F.col("_row").isNotNull()).select(*keep, "_row.instruction", "_row.input", "_row.output", "_row.task")


def binary_label(status: str | Column, approved: Sequence[str] = C.APPROVED_STATUSES) -> Column:
    """1 for an approved-like status, else 0 (also for NULL)."""
    return F.coalesce(as_column(status).isin(*approved), F.lit(False)).cast("int")


def classification_rows(
    df: DataFrame,
    name: str = "drug_name",
    structure: str = "canonical_smiles",
    status: str = "status",
    optional: Sequence[str] = ("molecular_weight", "molecular_formula"),
    approved: Sequence[str] = C.APPROVED_STATUSES,
) -> DataFrame:
    """Labelled rows with a structure, the first per structure by name.

    Copies of one structure combine map-side, so a structure holding a third of all
    rows costs one row per task. Equal names are ordered by the remaining columns.
    """
    extra = [column for column in optional if column in df.columns]
    labelled = df.filter(blank_to_null(structure).isNotNull()).select(
        F.col(name), F.col(structure), F.col(status), binary_label(status, approved).alias("label"), *extra
    )
    rest = [name, status, "label", *extra]
    first = labelled.groupBy(structure).agg(F.min(F.struct(*rest)).alias("_row"))
    return first.select(
        f"_row.{name}", structure, f"_row.{status}", "_row.label", *[f"_row.{c}" for c in extra]
    )


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(
        F.count_if(F.col(label) == 1).alias("positive"), F.count_if(F.col(label) == 0).alias("negative")
    )


def with_structure_length(
    df: DataFrame,
    structure: str,
    shortest: int = C.MIN_STRUCTURE_LENGTH,
    longest: int = C.MAX_STRUCTURE_LENGTH,
) -> DataFrame:
    """Optional filter on the structure length."""
    return df.filter(F.length(structure).between(shortest, longest))


def status_score(status: str | Column, scores: Mapping[str, float] = C.STATUS_SCORES) -> Column:
    """Score of a status, ignoring case; NULL for an unlisted one. The mapping is part
    of the plan, so there is no join."""
    lowered = F.lower(as_column(status))
    return F.coalesce(
        *[F.when(lowered == word, F.lit(float(score))) for word, score in scores.items()],
        F.lit(None).cast("double"),
    )


def length_budget(
    df: DataFrame,
    text: str,
    budget: int = C.PROMPT_TOKEN_BUDGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Whitespace-token count of the whole text, a flag, and the text within budget.

    A text within budget stays as it is; a longer one ends where its last token within
    budget ends, with its layout kept. NULL counts as empty.
    """
    counted = df.select(*keep, F.coalesce(text, F.lit("")).alias("_text"), F.size(tokens(text)).cast("long").alias("n_tokens"))
    # Every piece is a token with the whitespace before it.
    pieces = F.regexp_extract_all("_text", F.lit(f"{WHITESPACE}*{NON_WHITESPACE}+"), F.lit(0))
    within = F.array_join(F.slice(pieces, 1, budget), "")
    over = F.col("n_tokens") > budget
    return counted.select(*keep, "n_tokens", over.alias("over_budget"), F.when(over, within).otherwise(F.col("_text")).alias("text"))
