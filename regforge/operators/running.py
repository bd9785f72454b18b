"""Running totals in a stated order, without one task that sees all rows."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regforge.plans.stages import staged

_RANGE = "_range"


def with_running_totals(df: DataFrame, order: Sequence[str], totals: Mapping[str, str]) -> DataFrame:
    """Per row and entry ``value -> name`` of ``totals``, the sum of ``value`` over all rows
    before it by ``order`` as column ``name``.

    The rows are dealt into ranges of ``order`` and staged (a job); the sums of the ranges,
    one row per range, are added up in one task, those inside a range in the task of that
    range. ``order`` has to tell the rows apart; rows it leaves equal are one range and their
    order is arbitrary. Meant for narrow rows: what is not needed here is joined afterwards.
    """
    ranged = staged(df.repartitionByRange(*order).withColumn(_RANGE, F.spark_partition_id()))
    sums = ranged.groupBy(_RANGE).agg(*[F.sum(value).alias(name) for value, name in totals.items()])
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(_RANGE), *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_{name}") for name in totals.values()])
    inside = Window.partitionBy(_RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.select("*", *[F.coalesce(F.sum(value).over(inside), F.lit(0)).alias(name) for value, name in totals.items()])
    # One row per range, so as many as there are shuffle partitions.
    joined = placed.join(F.broadcast(offsets), _RANGE)
    return joined.select(*df.columns, *[(F.col(name) + F.col(f"_{name}")).alias(name) for name in totals.values()])
