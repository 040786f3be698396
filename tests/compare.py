"""Compare a Spark result with a SQL result: columns by name, rows in any order."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def sql_connection(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value if isinstance(value, (int, bool, str, type(None))) else str(value)


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(df, connection, sql):
    """None when equal, else a short description."""
    spark_names, spark_rows = as_rows(df.columns, df.collect())
    result = connection.execute(sql)
    sql_names, sql_rows = as_rows([d[0] for d in result.description], result.fetchall())
    if spark_names != sql_names:
        return f"columns {spark_names} != {sql_names}"
    if spark_rows != sql_rows:
        only_spark, only_sql = spark_rows - sql_rows, sql_rows - spark_rows
        return (
            f"rows {sum(spark_rows.values())} vs {sum(sql_rows.values())}, "
            f"spark only {sum(only_spark.values())}: {list(only_spark)[:3]}, "
            f"sql only {sum(only_sql.values())}: {list(only_sql)[:3]}"
        )
    return None
