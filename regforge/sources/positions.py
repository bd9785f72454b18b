"""Row numbers for tables without a key: the order of the files and of the rows in them."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regforge.operators.running import with_running_totals
from regforge.plans.stages import staged

#: Splits whose numbers are sent to every task: three longs each.
BROADCAST_SPLITS = 1_000_000


def numbered_rows(df: DataFrame, number: str = "row_number") -> DataFrame:
    """``df``, straight from a reader, with contiguous row numbers from 0 on.

    Files count in the order of their paths, rows as they stand in the file, however the
    files are cut into splits and dealt to tasks. Two narrow passes: one counts the rows per
    split and adds the counts up, one adds a split's number to the row's place in it. Parquet
    knows the place of a row; rows of other formats are staged once with a number per task,
    from which the place follows (this runs a job). No row is shuffled up to
    ``BROADCAST_SPLITS`` splits; beyond, the numbers are joined by split.
    """
    columns = [F.col(f"`{name}`") for name in df.columns]
    file = F.col("_metadata.file_path").alias("_file")
    try:
        rows = df.select(*columns, file, F.lit(0).cast("long").alias("_block"), F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:
        block = F.col("_metadata.file_block_start").alias("_block")
        rows = staged(df.select(*columns, file, block, F.monotonically_increasing_id().alias("_place")))
    splits = rows.groupBy("_file", "_block").agg(F.min("_place").alias("_least"), F.count(F.lit(1)).alias("_rows"))
    placed = with_running_totals(splits, ["_file", "_block"], {"_rows": "_before"})
    placed = staged(placed.select("_file", "_block", F.xxhash64("_file", "_block").alias("_split"), (F.col("_before") - F.col("_least")).alias("_shift")))
    sizes = placed.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_split").alias("different")).first()
    if sizes["n"] <= BROADCAST_SPLITS and sizes["n"] == sizes["different"]:
        found = rows.withColumn("_split", F.xxhash64("_file", "_block")).join(F.broadcast(placed.select("_split", "_shift")), "_split")
    else:
        found = rows.join(placed.drop("_split"), ["_file", "_block"])
    return found.select(*columns, (F.col("_place") + F.col("_shift")).alias(number))
