"""Delimited registry extracts: products, patents, exclusivity."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regforge.functions.columns import as_column

DELIMITER = "~"
ENCODING = "ISO-8859-1"


def normalized_header(name: str) -> str:
    return re.sub(" ", "_", name.lower().strip())


def normalize_headers(df: DataFrame) -> DataFrame:
    """Lower case, strip, blank to underscore. Metadata only."""
    return df.toDF(*[normalized_header(name) for name in df.columns])


def read_extract(
    spark: SparkSession,
    folder: str,
    file_name: str,
    delimiter: str = DELIMITER,
    encoding: str = ENCODING,
) -> DataFrame:
    """One named file anywhere below ``folder``; the header decides the columns, all text.

    Spark looks at the first line of the file while planning; the rows are split over
    tasks by byte range.
    """
    raw = (
        spark.read.option("sep", delimiter)
        .option("encoding", encoding)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_name)
        .csv(folder)
    )
    return normalize_headers(raw)


def read_products(spark: SparkSession, folder: str) -> DataFrame:
    return read_extract(spark, folder, "products.txt")


def read_patents(spark: SparkSession, folder: str, file_name: str = "patent.txt") -> DataFrame:
    return read_extract(spark, folder, file_name)


def read_exclusivity(spark: SparkSession, folder: str, file_name: str = "exclusivity.txt") -> DataFrame:
    return read_extract(spark, folder, file_name)


def parse_lines(
    df: DataFrame, line: str | Column, schema: T.StructType, delimiter: str = DELIMITER
) -> DataFrame:
    """The same for lines that already are a column."""
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    parsed = F.from_csv(as_column(line), ddl, {"sep": delimiter})
    return normalize_headers(df.select(parsed.alias("_row")).select("_row.*"))
