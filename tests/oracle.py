"""Runs registered queries against DuckDB and compares whole results.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

KIND = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int",
    "bigint": "long", "hugeint": "hugeint", "double": "double", "string": "string",
    "varchar": "string", "boolean": "boolean", "timestamp_ntz": "timestamp",
    "timestamp": "timestamp", "date": "date",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, queries, oracles) -> str:
    started = time.time()
    df = queries[name](spark, sf_dir)
    got = df.collect()
    took = time.time() - started
    if name not in oracles:
        return f"ROWS-ONLY {len(got)} rows {took:.1f}s"
    result = con.execute(oracles[name])
    kinds = {d[0]: str(d[1]).lower() for d in result.description}
    columns = list(kinds)
    expected = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"FAIL columns {sorted(df.columns)} != {sorted(columns)}"
    for f in df.schema.fields:
        left = KIND.get(f.dataType.simpleString(), f.dataType.simpleString())
        right = KIND.get(kinds[f.name], kinds[f.name])
        if left != right:
            return f"FAIL type of {f.name}: {left} != {right}"
    a, b = _rows(df.columns, got), _rows(columns, expected)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:2]
        only_b = [r for r in b if r not in set(a)][:2]
        return f"FAIL {len(a)} vs {len(b)} rows; only spark {only_a}; only sql {only_b}"
    return f"ok {len(a)} rows {took:.1f}s" + ("  EMPTY" if not a else "")


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracles = contract.queries(), contract.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            verdict = compare(spark, con, sf_dir, name, queries, oracles)
        except Exception as e:  # report and go on with the next query
            verdict = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        bad += not verdict.startswith(("ok", "ROWS"))
        print(f"{name:28s} {verdict}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    spark.stop()


if __name__ == "__main__":
    main()
