"""Run queries beside their SQL: python tests/check_oracles.py [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, float):
            return None if math.isnan(x) else x + 0.0
        return x

    return sorted(
        (tuple(value(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((x is None, str(type(x)), x) for x in r),
    )


KINDS = {"bigint": "int", "integer": "int", "int": "int", "hugeint": "huge",
         "varchar": "string", "string": "string", "double": "double"}


def compare(spark, con, name, sf_dir):
    """Problems found, as text; empty if both sides agree."""
    df = queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    relation = con.execute(oracle_sql()[name])
    columns = [d[0] for d in relation.description]
    kinds = [str(d[1]).lower() for d in relation.description]
    want = relation.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {df.columns} / {columns}"
    spark_kinds = dict(df.dtypes)
    for column, kind in zip(columns, kinds):
        if KINDS.get(spark_kinds[column], spark_kinds[column]) != KINDS.get(kind, kind):
            return f"type of {column}: {spark_kinds[column]} / {kind}"
    a, b = normal(got, df.columns), normal(want, columns)
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        return f"rows {len(a)} / {len(b)}; only here {sorted(left, key=str)[:3]}, only there {sorted(right, key=str)[:3]}"
    return ""


def main():
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.1f}s {problem}", flush=True)


if __name__ == "__main__":
    main()
