"""First distinct values per key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import as_column, joined
from regforge.functions.text import clean_name


def _first(df: DataFrame, key: str | Column, value: str | Column, position: str | Column, k: int, clean: bool = False) -> DataFrame:
    """``_key``, ``_value``, ``_position`` and ``_rank`` of the first ``k`` distinct values per key."""
    rows = df.select(
        (clean_name(key) if clean else as_column(key)).alias("_key"),
        F.nullif(as_column(value).cast("string"), F.lit("")).alias("_value"),
        as_column(position).alias("_position"),
    ).filter(F.col("_key").isNotNull() & F.col("_value").isNotNull())
    distinct = rows.groupBy("_key", "_value").agg(F.min("_position").alias("_position"))
    order = Window.partitionBy("_key").orderBy("_position", "_value")
    return distinct.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)


def first_k_distinct(
    df: DataFrame,
    key: str | Column,
    value: str | Column,
    position: str | Column,
    k: int,
    key_name: str = "drug_name",
    value_name: str = "values",
    separator: str = C.VALUE_SEPARATOR,
    clean: bool = False,
) -> DataFrame:
    """Per key (with ``clean``: a name, see ``clean_name``) the first ``k`` distinct non-blank values, joined in order of first
    appearance (ties by value).

    No group is ever collected: (key, value) pairs combine map-side, the window keeps
    ``k`` rows per key already before its shuffle (``WindowGroupLimit``), and the last
    step sees at most ``k`` rows per key, already partitioned and sorted by key.
    """
    top = _first(df, key, value, position, k, clean)
    ranked = [F.max(F.when(F.col("_rank") == i, F.col("_value"))) for i in range(1, k + 1)]
    return top.groupBy(F.col("_key").alias(key_name)).agg(
        F.concat_ws(separator, *ranked).alias(value_name)
    )


def first_k_places(df: DataFrame, key: str, value: str | Column, position: str | Column, k: int, name: str = "values") -> DataFrame:
    """The same with places, for merging: per key an array of at most ``k`` structs (position, value)."""
    top = _first(df, key, value, F.col(position).cast("long") if isinstance(position, str) else position, k)
    place = F.struct(F.col("_position").alias("position"), F.col("_value").alias("value"))
    return top.groupBy(F.col("_key").alias(key)).agg(F.array_sort(F.collect_list(place)).alias(name))


def rendered_places(places: str | Column, separator: str = C.VALUE_SEPARATOR) -> Column:
    """Such an array as ``first_k_distinct`` joins it; NULL if it is empty."""
    return joined(F.transform(places, lambda x: x["value"]), separator)
