"""Writers for the final products. Writing is the action; it runs in all tasks.

Nothing here coalesces to one file: a sink is a folder of part files.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


CSV_OPTIONS = {"header": "true", "escape": '"'}
JSON_OPTIONS = {"ignoreNullFields": "false"}


def jsonl_lines(df: DataFrame, name: str = "line") -> DataFrame:
    """Every row as the line that ``write_jsonl`` writes."""
    return df.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias(name))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object per row, text unescaped, NULL fields kept."""
    df.write.mode(mode).options(**JSON_OPTIONS).json(path)


def write_sorted(
    df: DataFrame, path: str, keys: Sequence[str], ties: Sequence[str] = (), files: int | None = None, fmt: str = "parquet"
) -> None:
    """A total order over part files: read in the order of their names, the rows are sorted.

    Rows are dealt by ranges of keys and ``ties`` whose bounds come from a sample, and sorted
    inside each range. ``ties`` order the rows of one key, so a key that holds a large share
    of the rows spans several files.
    """
    order = [*keys, *ties]
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    options = {"csv": CSV_OPTIONS, "json": JSON_OPTIONS}.get(fmt, {})
    ranged.sortWithinPartitions(*order).write.mode("overwrite").options(**options).format(fmt).save(path)


def write_split(df: DataFrame, path: str, split: str = "split", fmt: str = "json") -> None:
    """One sub-folder per split value, from a single pass, written as ``write_csv`` and
    ``write_jsonl`` write."""
    options = {"csv": CSV_OPTIONS, "json": JSON_OPTIONS}.get(fmt, {})
    df.write.mode("overwrite").options(**options).partitionBy(split).format(fmt).save(path)


def stats_document(counts: DataFrame, dataset: str = "dataset", split: str = "split", rows: str = "rows") -> DataFrame:
    """One row per data set with a map split -> rows. ``counts`` is already aggregated:
    a handful of rows."""
    entry = F.struct(F.col(split), F.col(rows))
    return counts.groupBy(dataset).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("splits")
    )


def write_result(path: str, **parts: DataFrame) -> None:
    """A nested result document as one JSON folder per part, e.g. ``summary``,
    ``by_task`` and ``predictions``. The row-level parts grow with the data, so they
    are written by all tasks instead of being nested into one document."""
    for name, df in parts.items():
        write_jsonl(df, f"{path.rstrip('/')}/{name}")
