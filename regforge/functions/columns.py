"""Small building blocks shared by the operators."""

from collections.abc import Callable, Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: str | Column, trim: bool = False) -> Column:
    """NULL for NULL and ''; with ``trim`` also for a run of blanks, else trimmed text."""
    column = as_column(value)
    return F.nullif(F.trim(column) if trim else column, F.lit(""))


def fill(template: str, **values: str | Column) -> Column:
    """Concatenate a ``{placeholder}`` template; NULL if any used value is NULL."""
    parts: list[Column] = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(as_column(values[field]))
    return F.concat(*parts) if parts else F.lit("")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often body uses it.

    Inside array lambdas Catalyst has no common-subexpression elimination, so the
    value is passed as a lambda variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def joined(values: Column, separator: str) -> Column:
    """Array to text, NULL if nothing is left."""
    return F.nullif(F.array_join(values, separator), F.lit(""))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where whole is 0 or NULL."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def harmonic_mean(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def packed_position(major: str | Column, minor: str | Column, minor_bits: int = 20) -> Column:
    """One sortable long from (page or file number, position within it).

    A long keeps ``min(position)`` in a hash aggregate; a struct would force a sort.
    Fails the query if a position does not fit, rather than reordering silently.
    """
    width = 1 << minor_bits
    major, minor = as_column(major).cast("long"), as_column(minor).cast("long")
    return F.when(minor.between(0, width - 1), major * F.lit(width) + minor).otherwise(
        F.when(major.isNotNull() & minor.isNotNull(), F.raise_error(F.lit("position out of range")).cast("long"))
    )


def explode_rows(
    df: DataFrame,
    array: str | Column,
    name: str,
    keep: Sequence[str | Column] = (),
    position: str | None = None,
) -> DataFrame:
    """One row per array element; rows with an empty or NULL array disappear.

    For a plain ``explode`` Catalyst infers the filter ``size(array) > 0`` and pushes it
    below the expression that builds the array, which then is built twice per row.
    Exploding with ``_outer`` and dropping the row of an empty array afterwards gives
    the same rows and builds it once.
    """
    place = position or "_position_in_array"
    rows = df.select(*keep, F.posexplode_outer(array).alias(place, name))
    rows = rows.filter(F.col(place).isNotNull())
    return rows if position else rows.drop(place)
