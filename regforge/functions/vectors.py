"""Vector functions over array columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from regforge.functions.columns import as_column


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(left: str | Column, right: str | Column) -> Column:
    """Cosine of two vectors; 0 if one has no length, NULL if one is NULL."""
    left, right = as_column(left), as_column(right)
    norm = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when(norm > 0, dot(left, right) / norm).when(norm == 0, F.lit(0.0))
