"""Intervals for means and other ratios of sums: a Poisson bootstrap in one aggregate.

Instead of drawing samples with replacement, every sample gets a Poisson(1) weight per
replicate, taken from a hash of its id. So all replicates are sums over one pass, combined
map-side to one row per group and replicate and task; nothing is drawn again, and the numbers
do not depend on how the rows are partitioned.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPLICATE, WEIGHT = "replicate", "weight"
#: A Poisson(1) weight above this has a chance below 2 ** -32.
_LARGEST = 12


def poisson_limits() -> list[str]:
    """The weight is the number of these 8-digit hex numbers that a hash reaches."""
    share, limits = 0.0, []
    for k in range(_LARGEST):
        share += math.exp(-1) / math.factorial(k)
        if (limit := round(share * 2**32)) >= 2**32:
            break
        limits.append(f"{limit:08x}")
    return limits


def _weight_of(digits: Column) -> Column:
    """Nested comparisons, the likely ones first: most hashes need one or two."""
    out = F.lit(len(poisson_limits()))
    for weight, limit in reversed(list(enumerate(poisson_limits()))):
        out = F.when(digits < limit, F.lit(weight)).otherwise(out)
    return out


def replicate_sums(df: DataFrame, sample_id: str, values: Sequence[str], by: Sequence[str] = (), replicates: int = 200, seed: int = 42) -> DataFrame:
    """Per group and replicate the weighted sums of ``values`` and the sum of the weights.

    Any ratio of sums (a mean, corpus BLEU) of these rows is a bootstrap replicate of it.
    Samples with a NULL id share one weight.
    """
    rows = df.select(*by, F.col(sample_id).alias("_id"), *[F.col(v).cast("double").alias(v) for v in values], F.explode(F.sequence(F.lit(0), F.lit(replicates))).alias(REPLICATE))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(REPLICATE).cast("string"), F.lit(":"), F.coalesce(F.col("_id").cast("string"), F.lit("")))), 1, 8)
    rows = rows.withColumn("_digits", digits).withColumn(WEIGHT, F.when(F.col(REPLICATE) == 0, 1).otherwise(_weight_of(F.col("_digits"))))
    return rows.groupBy(*by, REPLICATE).agg(F.sum(WEIGHT).alias(WEIGHT), *[F.sum(F.col(WEIGHT) * F.col(v)).alias(v) for v in values])


def intervals(sums: DataFrame, values: Sequence[str], by: Sequence[str] = (), level: float = 0.95) -> DataFrame:
    """Per group and value: ``value`` (of the sample), ``low`` and ``high`` of the means, with
    the percentiles interpolated. A replicate without weight counts for nothing."""
    tail = (1 - level) / 2
    entries = F.array(*[F.struct(F.lit(v).alias("metric"), F.try_divide(F.col(v), F.col(WEIGHT)).alias("mean")) for v in values])
    means = sums.select(*by, REPLICATE, F.inline(entries))
    drawn = F.when(F.col(REPLICATE) > 0, F.col("mean"))
    return means.groupBy(*by, "metric").agg(
        F.max(F.when(F.col(REPLICATE) == 0, F.col("mean"))).alias("value"),
        F.percentile(drawn, F.lit(tail)).alias("low"),
        F.percentile(drawn, F.lit(1 - tail)).alias("high"),
    )


def bootstrap_means(df: DataFrame, sample_id: str, values: Sequence[str], by: Sequence[str] = (), replicates: int = 200, level: float = 0.95, seed: int = 42) -> DataFrame:
    """Means of ``values`` with their bootstrap intervals, per group."""
    return intervals(replicate_sums(df, sample_id, values, by, replicates, seed), values, by, level)
