"""Equi-joins that stay splittable when one key holds a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RIGHT_KEY = "_key"


def splittable_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    """``left`` joined with ``right`` on one key each; the right key comes out as ``_key``.

    The adaptive skew join cuts a hot partition into pieces only if both inputs of the
    join come straight from an exchange. An input that was aggregated by the same key
    needs no exchange any more, and then a hot key stays in one task. A hash of the key
    as second join key changes no result, but is not what the input was partitioned by,
    so the (small) aggregated side is exchanged once more and the hot key can be split.
    A side small enough is still broadcast.
    """
    kind = left.schema[left_key].dataType
    keyed = right.withColumn(RIGHT_KEY, F.col(right_key).try_cast(kind)).drop(
        *[right_key] if right_key in left.columns else []
    )
    same = left[left_key] == keyed[RIGHT_KEY]
    return left.join(keyed, same & (F.xxhash64(left[left_key]) == F.xxhash64(keyed[RIGHT_KEY])), how)


def left_join_many(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join where the right side may repeat a key any number of times.

    ``left.on`` must be unique. Spark can split a skewed partition of the *right* side
    only in an inner join, and can broadcast the left side only there, so matched and
    unmatched rows are two joins; what ``left`` is computed from is exchanged once and
    used by both.
    """
    added = [name for name in right.columns if name != on]
    matched = splittable_join(left, right, on, on, "inner").select(*left.columns, *added)
    missing = left.join(right.select(on).distinct(), on, "left_anti")
    empty = [F.lit(None).cast(right.schema[name].dataType).alias(name) for name in added]
    return matched.unionByName(missing.select(*left.columns, *empty))
