"""Attribute look-up joins against a structure dictionary."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regforge import constants as C
from regforge.functions.text import clean_name
from regforge.operators.joins import splittable_join


def one_row_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per key by ``order`` (remaining columns break ties). Combines map-side."""
    lead = [key, *order]
    rest = [name for name in df.columns if name not in lead]
    first = F.min(F.struct(*order, *rest)).alias("_row")
    picked = df.filter(F.col(key).isNotNull()).groupBy(key).agg(first)
    return picked.select(key, *[F.col(f"_row.{name}").alias(name) for name in [*order, *rest]]).select(
        *df.columns
    )


def lookup_names(df: DataFrame, name: str, dictionary: DataFrame, key: str = "drug_name") -> DataFrame:
    """Distinct usable names with their dictionary attributes; a miss stays as a row of
    NULLs. The dictionary must hold one row per name."""
    names = df.select(F.col(name).alias(key), clean_name(name).alias("_clean")).filter(F.col("_clean").isNotNull())
    found = dictionary.withColumn("_clean", clean_name(key)).drop(key)
    return names.distinct().join(found, "_clean", "left").drop("_clean")


def _joinable(df: DataFrame, name: str) -> Column:
    """A name as it takes part in joins: cleaned if it is text."""
    return clean_name(name) if isinstance(df.schema[name].dataType, T.StringType) else F.col(name)


def _filled(df: DataFrame, attribute: str) -> Column:
    """Whether a row has the attribute: not NULL, and not blank if it is text."""
    is_text = isinstance(df.schema[attribute].dataType, T.StringType)
    return (clean_name(attribute) if is_text else F.col(attribute)).isNotNull()


def enrich(
    df: DataFrame,
    name: str,
    dictionary: DataFrame,
    key: str = "drug_name",
    suffix: str = C.LOOKUP_SUFFIX,
) -> DataFrame:
    """All rows of ``df`` with the attributes of their name; clashing attribute columns
    get ``suffix``. Names are compared without whitespace at their ends. The looked-up
    name is shown as the row has it, also where there is no hit; a blank one is NULL.

    With one dictionary row per key the answer equals "distinct names, look them up,
    join back", without those two extra shuffles.
    """
    attributes = [c for c in dictionary.columns if c != key]
    names = {c: c + suffix if c in df.columns else c for c in attributes}
    left = df.withColumn("_name", _joinable(df, name))
    right = dictionary.withColumn("_dictionary_name", _joinable(dictionary, key)).drop(key)
    found = splittable_join(left, right.withColumnsRenamed(names), "_name", "_dictionary_name", "left")
    asked = F.when(F.col("_name").isNotNull(), F.col(name))
    shown = [] if key == name else [asked.alias(key + suffix if key in df.columns else key)]
    return found.select(*df.columns, *shown, *names.values())


def update_from(
    df: DataFrame,
    name: str,
    dictionary: DataFrame,
    key: str,
    columns: Sequence[str],
    found: str | None = None,
) -> DataFrame:
    """Overwrite ``columns`` of every row whose name has a dictionary row; keep the rest.

    ``found`` is the attribute that must be filled, and not blank, for a hit (default: the
    first of ``columns``). The dictionary must hold one row per key.
    """
    found = found or columns[0]
    new = dictionary.select(
        _joinable(dictionary, key).alias("_dictionary_key"),
        _filled(dictionary, found).alias("_found"),
        *[F.col(c).alias(f"_new_{c}") for c in columns],
    )
    hit = F.coalesce(F.col("_found"), F.lit(False))
    left = df.withColumn("_name", _joinable(df, name))
    joined = splittable_join(left, new, "_name", "_dictionary_key", "left")
    return joined.select(
        *[
            F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def missing_attribute(df: DataFrame, attribute: str) -> DataFrame:
    """Rows without the attribute (NULL, or blank text). No cap."""
    return df.filter(~_filled(df, attribute))


def coverage(df: DataFrame, attribute: str) -> DataFrame:
    """Total, found and not found in one row; blank text is not found."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_filled(df, attribute)).alias("found"),
        F.count_if(~_filled(df, attribute)).alias("not_found"),
    )
