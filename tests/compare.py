"""Run registered queries next to their SQL and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if value is None:
            return (0, "")
        if isinstance(value, bool):
            return (1, str(value))
        if isinstance(value, float):
            return (2, "nan" if math.isnan(value) else repr(value + 0.0))
        return (1, str(value))

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    frame = query(spark, sf_dir)
    got = [tuple(row) for row in frame.collect()]
    relation = connection.sql(sql)
    want = relation.fetchall()
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(relation.columns)}"
    names = {c: t for c, t in frame.dtypes}
    kinds = dict(zip(relation.columns, [str(t) for t in relation.types], strict=True))
    pairs = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    wrong = {c: (t, kinds[c]) for c, t in names.items() if pairs.get(t, t) != kinds[c]}
    a, b = canonical(got, frame.columns), canonical(want, relation.columns)
    if a != b:
        only_a, only_b = [r for r in a if r not in set(b)], [r for r in b if r not in set(a)]
        return f"rows {len(a)} vs {len(b)}; spark only {only_a[:2]}; sql only {only_b[:2]}"
    return f"types {wrong}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            if name in entry.oracle_sql():
                result = compare(
                    spark, connection, entry.queries()[name], entry.oracle_sql()[name], sf_dir
                )
                status = "ok" if result is None else f"DIFF {result[:1500]}"
            else:
                rows = entry.queries()[name](spark, sf_dir).collect()
                status = f"rows {len(rows)} first {rows[0] if rows else None}"
        except Exception as error:
            status = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {status}", flush=True)
