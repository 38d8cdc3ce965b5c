"""Run the queries and their SQL side by side: python -m checks.compare SF_DIR [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.13g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return str(value)


def _normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


# Spark type -> SQL type of the same column.
_SQL_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def _unlike(df: DataFrame, names: list[str], sql_types: list[str]) -> list[str]:
    ours = {f.name: _SQL_TYPE.get(f.dataType.simpleString()) for f in df.schema}
    return [f"{n}: {ours[n]} vs {t}" for n, t in zip(names, sql_types, strict=True) if ours[n] != t]


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree on names, types of columns and all rows; else what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    found_types = [str(d[1]) for d in found.description]
    expected = found.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    unlike = _unlike(df, names, found_types)
    if unlike:
        return f"types differ: {unlike}"
    left, right = _normal(df.columns, df.collect()), _normal(names, expected)
    if left == right:
        return None
    only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
    return f"rows {len(left)} vs {len(right)}; only ours {len(only_left)} {only_left[:2]}; only SQL {len(only_right)} {only_right[:2]}"


def main(sf: str, names: list[str]) -> int:
    from checks.catalog import QUERIES
    from checks.oracle import statements

    spark = (
        SparkSession.builder.master("local[8]").appName("compare").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_ZONE", "UTC")).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = oracle_connection(sf), statements(), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001 - reported, and the run goes on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ; without query: {sorted(set(sql) - set(QUERIES))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
