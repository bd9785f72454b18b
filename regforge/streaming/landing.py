"""Pages land in a folder one after another; flatten the new ones and append them.

This is the page loop of a download as a file stream: the checkpoint remembers which
pages are done, so a rerun continues where the last one stopped. The flatteners are
narrow and stateless, hence no watermark and no state.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from regforge.plans.incremental import NameState, merge_landing


def stream_pages(
    spark: SparkSession, path: str, schema: T.StructType, pages_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", pages_per_batch)
        .json(path)
    )


def keep_names(
    pages: DataFrame, landed: Callable[[DataFrame], DataFrame], state: NameState, checkpoint: str
) -> StreamingQuery:
    """Merge all pages that are there into the stored state of the names and stop.

    ``landed`` makes the state of one batch (``plans.incremental.landing``). A batch that is
    repeated after a failure changes nothing, so each page counts once.
    """

    def merge(batch: DataFrame, _: int) -> None:
        merge_landing(batch.sparkSession, state, landed(batch))

    return pages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def land(
    pages: DataFrame, flatten: Callable[[DataFrame], DataFrame], table: str, checkpoint: str
) -> StreamingQuery:
    """Append the rows of all pages that are there and stop."""
    return (
        flatten(pages)
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
