"""One row per entity name: where it was seen and its first known status."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import as_column, blank_to_null, explode_rows
from regforge.functions.text import clean_name


#: Bits of the mask that remembers the sources of a name.
_MAX_SOURCES = 62


def explode_names(
    df: DataFrame,
    names: str | Column,
    keep: Sequence[str | Column] = (),
    name: str = "drug_name",
    separator: str | None = C.NAME_SEPARATOR,
) -> DataFrame:
    """One row per name in a delimited list column; names trimmed, blanks dropped.

    ``separator=None`` means the column already is an array, so that names which contain
    the separator stay whole. Trimming and dropping come after the explode, where they
    are generated code instead of interpreted array lambdas.
    """
    # The separator is matched literally.
    array = as_column(names) if separator is None else F.split(as_column(names), f"\\Q{separator}\\E")
    rows = explode_rows(df, array, "_name", keep).withColumn(name, clean_name("_name"))
    return rows.drop("_name").filter(F.col(name).isNotNull())


def names_from_columns(
    df: DataFrame, columns: Sequence[str], source: str, status: str | Column | None = None
) -> DataFrame:
    """Names of a listing: every present name column, one source and one status.

    All columns are stacked in one pass over the table. Names are clean, blank ones dropped.
    """
    present = [name for name in columns if name in df.columns]
    status = F.lit(C.LISTED_STATUS) if status is None else as_column(status)
    stacked = explode_rows(
        df,
        F.array(*[F.col(name).cast("string") for name in present]).cast("array<string>"),
        "drug_name",
        [status.cast("string").alias("status")],
    )
    return stacked.select(
        clean_name("drug_name").alias("drug_name"), F.lit(source).alias("source"), "status", F.lit(0).cast("long").alias("position")
    ).filter(F.col("drug_name").isNotNull())


def names_from_lists(
    df: DataFrame,
    names: str | Column,
    source: str,
    status: str | Column,
    position: str | Column,
    separator: str | None = C.NAME_SEPARATOR,
) -> DataFrame:
    """Names of a table with a name list per row (see ``explode_names``) and its own
    status. ``position`` (long) is the row order."""
    keep = [
        as_column(status).cast("string").alias("status"),
        as_column(position).cast("long").alias("position"),
    ]
    rows = explode_names(df, names, keep, separator=separator)
    return rows.select("drug_name", F.lit(source).alias("source"), "status", "position")


def merged_names(sources: Sequence[DataFrame], order: Sequence[str], clean: bool = True) -> DataFrame:
    """Union of tagged names to one row per name: the ``mask`` of its sources by rank, and
    the ``first`` status with rank and position.

    ``order`` ranks the sources; a source that it lacks is an error. ``clean=False`` says that the names already are clean, as
    ``names_from_columns`` and ``names_from_lists`` return them.

    Stage one groups by (name, source, status) with only longs in the buffer: a hash
    aggregate that combines map-side, so a name holding a third of all rows leaves
    each task as a few rows. Stage two sees those few rows only.
    """
    if len(order) > _MAX_SOURCES:
        raise ValueError(f"more than {_MAX_SOURCES} sources")
    rank = F.coalesce(*[F.when(F.col("source") == name, F.lit(i)) for i, name in enumerate(order)])
    tagged = reduce(DataFrame.unionByName, sources).select(
        (clean_name("drug_name") if clean else F.col("drug_name")).alias("drug_name"),
        F.coalesce(rank, F.raise_error(F.concat(F.lit("source without a rank: "), "source")).cast("int")).alias("rank"),
        blank_to_null("status").alias("status"),
        "position",
    )
    seen = (
        tagged.filter(F.col("drug_name").isNotNull())
        .groupBy("drug_name", "rank", "status")
        .agg(F.min("position").alias("position"))
    )
    ordered = F.when(F.col("status").isNotNull(), F.struct("rank", "position", "status"))
    return seen.groupBy("drug_name").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("rank"))).alias("mask"), F.min(ordered).alias("first")
    )


def rendered_names(merged: DataFrame, order: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``merged_names`` as ``(drug_name, source, status)``: the sources listed alphabetically."""
    listed = [
        F.when(F.col("mask").bitwiseAND(1 << order.index(name)) != 0, F.lit(name))
        for name in sorted(order)
    ]
    return merged.select(
        "drug_name",
        F.concat_ws(C.NAME_SEPARATOR, *listed).alias("source"),
        F.col("first.status").alias("status"),
        *keep,
    )


def name_dictionary(sources: Sequence[DataFrame], order: Sequence[str], clean: bool = True) -> DataFrame:
    """Union of tagged names to ``(drug_name, source, status)``: the status is the first
    non-missing one by (source rank, position). See ``merged_names``."""
    return rendered_names(merged_names(sources, order, clean), order)
