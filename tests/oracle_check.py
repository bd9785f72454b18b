"""Run a query in Spark and its SQL in DuckDB and compare them value by value."""

import math

import duckdb
from workloads.inputs import TABLES


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET threads TO 4")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}"
    return "NULL" if value is None else str(value)


def difference(spark_df, connection, sql: str) -> str | None:
    """None if equal, else what differs."""
    columns = sorted(spark_df.columns)
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = sorted(tuple(_cell(row[i]) for i in order) for row in result.fetchall())
    have = sorted(tuple(_cell(v) for v in row) for row in spark_df.select(*[f"`{c}`" for c in columns]).collect())
    if len(want) != len(have):
        return f"{len(have)} rows in Spark, {len(want)} in SQL"
    wrong = [(h, w) for h, w in zip(have, want) if h != w]
    if wrong:
        return f"{len(wrong)} rows differ, first: {wrong[0]}"
    kinds = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    sql_kinds = dict(zip(names, [str(column[1]) for column in result.description]))
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {c: (kinds[c], sql_kinds[c]) for c in columns if same.get(kinds[c]) != sql_kinds[c]}
    return f"types {odd}" if odd else None
