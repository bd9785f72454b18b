"""Landed structure look-up payloads to the structure table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge.functions.columns import blank_to_null


def first_filled(*columns: str | Column) -> Column:
    """First value that is neither NULL nor blank."""
    return F.coalesce(*[blank_to_null(column) for column in columns])


def flatten_structures(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """First property set per payload; a payload without one is an all-NULL miss."""
    rows = pages.select(
        *keep, F.get(F.col("PropertyTable.Properties"), F.lit(0)).alias("_p")
    )
    return rows.select(
        *keep,
        F.col("_p.CID").alias("cid"),
        blank_to_null("_p.MolecularFormula").alias("molecular_formula"),
        F.col("_p.MolecularWeight").try_cast("double").alias("molecular_weight"),
        first_filled("_p.CanonicalSMILES", "_p.ConnectivitySMILES").alias("canonical_smiles"),
        blank_to_null("_p.IsomericSMILES").alias("isomeric_smiles"),
        blank_to_null("_p.InChI").alias("inchi"),
        blank_to_null("_p.InChIKey").alias("inchi_key"),
    )
