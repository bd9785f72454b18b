"""Extracts -> one row per entity -> instruction and classification data sets."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import as_column
from regforge.functions.text import clean_name
from regforge.operators.instruct import classification_rows, instruction_rows
from regforge.operators.joins import left_join_many
from regforge.operators.names import (
    explode_names,
    name_dictionary,
    names_from_columns,
    names_from_lists,
)
from regforge.operators.split import split_counts, split_exact, split_stratified
from regforge.operators.topk import first_k_distinct
from regforge.plans.stages import staged
from regforge.sources.trials import failed_trials

REGISTRY_NAME_COLUMNS = ("ingredient", "trade_name")
LABEL_NAME_COLUMNS = ("brand_name", "generic_name")


@dataclass(frozen=True)
class Extracts:
    """Flat inputs; an absent one is None. Without ``failed_trials`` the failure reasons
    come from the ``trials`` that failed. ``position`` is the row order (a long) of the
    tables whose order decides which value comes first."""

    registry: DataFrame | None = None
    labels: DataFrame | None = None
    trials: DataFrame | None = None
    structures: DataFrame | None = None
    adverse_events: DataFrame | None = None
    failed_trials: DataFrame | None = None


def entity_names(
    extracts: Extracts,
    registry_columns: Sequence[str] = REGISTRY_NAME_COLUMNS,
    label_columns: Sequence[str] = LABEL_NAME_COLUMNS,
    names: str | Column = "drug_names",
    separator: str | None = C.NAME_SEPARATOR,
    position: str | Column = "position",
) -> DataFrame:
    """``(drug_name, source, status)`` over all extracts that are there."""
    tagged = []
    if extracts.registry is not None:
        tagged.append(names_from_columns(extracts.registry, registry_columns, C.REGISTRY_SOURCE))
    if extracts.labels is not None:
        tagged.append(names_from_columns(extracts.labels, label_columns, C.LABEL_SOURCE))
    if extracts.trials is not None:
        tagged.append(
            names_from_lists(extracts.trials, names, C.TRIAL_SOURCE, "status", position, separator)
        )
    return name_dictionary(tagged, [C.REGISTRY_SOURCE, C.LABEL_SOURCE, C.TRIAL_SOURCE], clean=False)


def top_reactions(adverse_events: DataFrame, position: str | Column = "position",
                  k: int = C.MAX_REACTIONS) -> DataFrame:
    return first_k_distinct(
        adverse_events, "drug_name", "reactions", position, k, value_name="adverse_reactions", clean=True
    )


def top_reasons(failed_trials: DataFrame, names: str | Column = "drug_names", position: str | Column = "position",
                k: int = C.MAX_REASONS, separator: str | None = C.NAME_SEPARATOR) -> DataFrame:
    keep = ["why_stopped", as_column(position).alias("position")]
    rows = explode_names(failed_trials, names, keep, separator=separator)
    return first_k_distinct(rows, "drug_name", "why_stopped", "position", k, value_name="failure_reason")


def unified_table(
    extracts: Extracts,
    names: str | Column = "drug_names",
    separator: str | None = C.NAME_SEPARATOR,
    position: str | Column = "position",
    **listing_options,
) -> DataFrame:
    """One row per entity name (more where the structure table repeats it).

    ``names``, ``separator`` and ``position`` describe the trial tables, e.g.
    ``names="drug_name_list", separator=None`` for name arrays.

    Every input is aggregated by name before it is joined, so the joins share one
    partitioning by name; the structure join, the only one that can multiply rows,
    comes last. It reads its left side twice, so the joined names are staged before it:
    with structures this runs a job. That also keeps the filters of later steps from
    sinking below the aggregates to the names as they came.
    """
    unified = entity_names(
        extracts, names=names, separator=separator, position=position, **listing_options
    )
    if extracts.adverse_events is not None:
        unified = unified.join(top_reactions(extracts.adverse_events), "drug_name", "left")
    failed = extracts.failed_trials
    if failed is None and extracts.trials is not None and "why_stopped" in extracts.trials.columns:
        failed = failed_trials(extracts.trials)
    if failed is not None:
        reasons = top_reasons(failed, names, position, separator=separator)
        unified = unified.join(reasons, "drug_name", "left")
    if extracts.structures is not None:
        named = extracts.structures.withColumn("drug_name", clean_name("drug_name"))
        unified = left_join_many(staged(unified), named, "drug_name")
    return unified


@dataclass(frozen=True)
class Datasets:
    unified: DataFrame
    instructions: DataFrame
    classification: DataFrame | None
    stats: DataFrame


def build_datasets(extracts: Extracts, split_key: str = "sample", **options) -> Datasets:
    """All products of the pipeline, each instruction and classification row with its
    ``split``. The unified table and both row sets are read several times, hence staged:
    this runs the jobs that write them.

    ``split_key='sample'`` splits rows; ``'drug_name'`` keeps an entity on one side.
    """
    unified = staged(unified_table(extracts, **options))
    rows = instruction_rows(unified, keep=["drug_name"])
    sample = F.sha2(F.concat_ws("\u0001", "task", "instruction", "input", "output"), 256)
    instructions = staged(rows.withColumn("sample", sample))
    instructions = split_exact(instructions, split_key).drop("sample")
    stats = split_counts(instructions, "instructions")
    classification = None
    if "canonical_smiles" in unified.columns:
        labelled = staged(classification_rows(unified))
        classification = split_stratified(labelled, "canonical_smiles", "label")
        stats = stats.unionByName(split_counts(classification, "classification"))
    return Datasets(unified, instructions, classification, stats)
