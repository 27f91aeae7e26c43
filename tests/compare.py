"""Run registered queries on Spark and their SQL on DuckDB, and compare whole results."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(str(row[i]) for i in order) for row in rows])


def difference(df, connection, sql) -> str | None:
    """None when columns and rows agree, else a short description."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {name: TYPES.get(field.dataType.simpleString()) for name, field in zip(df.columns, df.schema.fields)}
    given = {d[0]: str(d[1]) for d in cursor.description}
    if kinds != given:
        return f"types {sorted(kinds.items())} != {sorted(given.items())}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, cursor.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"\n  {str(a)[:700]}\n  {str(b)[:700]}"
    return None


if __name__ == "__main__":
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf)
            if name in sqls:
                found = difference(df, connection, sqls[name])
                result = f"{'ok' if found is None else 'DIFFERENT ' + found} ({df.count()} rows)"
            else:
                result = f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {result}", flush=True)
