"""Landed trial pages to one trials table, and the filtered views on it."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import as_column, blank_to_null, explode_rows, joined


def flatten_trials(
    pages: DataFrame,
    drug_types: Sequence[str] = C.DRUG_INTERVENTION_TYPES,
    keep: Sequence[str] = (),
    position: str | None = None,
    arrays: bool = False,
) -> DataFrame:
    """One row per study. With ``arrays`` also ``drug_name_list`` and ``phase_list``:
    names that contain the separator survive only there."""
    kept = [*keep, *([position] if position else [])]
    rows = explode_rows(pages, "studies", "_s", keep, position).select(
        *kept, F.col("_s.protocolSection").alias("_p")
    )
    interventions = F.col("_p.armsInterventionsModule.interventions")
    drugs = F.transform(
        F.filter(interventions, lambda x: x["type"].isin(*drug_types)),
        lambda x: F.coalesce(x["name"], F.lit("")),
    )
    kinds = F.transform(interventions, lambda x: F.coalesce(x["type"], F.lit("")))
    measures = F.transform(
        F.col("_p.outcomesModule.primaryOutcomes"), lambda x: F.coalesce(x["measure"], F.lit(""))
    )
    phases = F.col("_p.designModule.phases")
    columns = {
        "nct_id": blank_to_null("_p.identificationModule.nctId"),
        "title": blank_to_null("_p.identificationModule.briefTitle"),
        "official_title": blank_to_null("_p.identificationModule.officialTitle"),
        "status": blank_to_null("_p.statusModule.overallStatus"),
        "why_stopped": blank_to_null("_p.statusModule.whyStopped"),
        "phase": joined(phases, C.NAME_SEPARATOR),
        "study_type": blank_to_null("_p.designModule.studyType"),
        "enrollment": F.col("_p.designModule.enrollmentInfo.count").try_cast("int"),
        "conditions": joined(F.col("_p.conditionsModule.conditions"), C.NAME_SEPARATOR),
        "drug_names": joined(drugs, C.NAME_SEPARATOR),
        "intervention_types": joined(kinds, C.NAME_SEPARATOR),
        "primary_outcomes": joined(measures, C.NAME_SEPARATOR),
        "start_date": blank_to_null("_p.statusModule.startDateStruct.date"),
        "completion_date": blank_to_null("_p.statusModule.completionDateStruct.date"),
        "sponsor": blank_to_null("_p.sponsorCollaboratorsModule.leadSponsor.name"),
        "sponsor_type": blank_to_null("_p.sponsorCollaboratorsModule.leadSponsor.class"),
    }
    if arrays:
        columns["drug_name_list"] = drugs
        columns["phase_list"] = phases
    return rows.select(*kept, *[column.alias(name) for name, column in columns.items()])


def failed_trials(
    trials: DataFrame,
    status: str = "status",
    reason: str = "why_stopped",
    statuses: Sequence[str] = C.STOPPED_STATUSES,
) -> DataFrame:
    """Stopped trials that say why."""
    return trials.filter(F.col(status).isin(*statuses) & (F.col(reason) != ""))


def completed_trials(
    trials: DataFrame,
    phases: str | Column = "phase_list",
    status: str = "status",
    statuses: Sequence[str] = C.COMPLETED_STATUSES,
    wanted_phases: Sequence[str] = C.LATE_PHASES,
) -> DataFrame:
    """Completed trials with at least one of the wanted phases."""
    wanted = F.array(*[F.lit(phase) for phase in wanted_phases])
    return trials.filter(
        F.col(status).isin(*statuses) & F.arrays_overlap(as_column(phases), wanted)
    )
