"""Run a query and its SQL side by side and describe every difference.

From the shell: python tests/oracle.py <sf> [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v: object) -> object:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _family(name: str) -> str:
    name = name.lower()
    for family, words in {
        "int": ("tinyint", "smallint", "int", "integer"), "bigint": ("bigint", "hugeint"),
        "double": ("double", "float"), "string": ("varchar", "string"), "time": ("timestamp",),
    }.items():
        if any(name == w or (family == "time" and name.startswith(w)) for w in words):
            return family
    return name


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    names = sorted(df.columns)
    cur = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in cur.description}
    expected_rows = cur.fetchall()
    problems = []
    if names != sorted(theirs):
        return [f"columns {names} != {sorted(theirs)}"]
    types = dict(df.dtypes)
    for n in names:
        if _family(types[n]) != _family(theirs[n]):
            problems.append(f"type of {n}: {types[n]} != {theirs[n]}")
    at = [list(theirs).index(n) for n in names]
    expected = Counter(tuple(_plain(r[i]) for i in at) for r in expected_rows)
    got = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    if not expected:
        problems.append("no rows expected, so nothing is checked")
    if got != expected:
        problems.append(f"rows {sum(got.values())} != {sum(expected.values())}" if sum(got.values()) != sum(expected.values()) else "values differ")
        problems += [f"  only here {list((got - expected).items())[:2]}", f"  only there {list((expected - got).items())[:2]}"]
    return problems


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries


    sf_dir = f"/root/testdata/sf{argv[0]}"
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = database(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if len(argv) > 1 and not any(name.startswith(a) for a in argv[1:]):
            continue
        begun = time.time()
        try:
            problems = compare(query(spark, sf_dir), con, sql[name]) if name in sql else [f"(no sql) rows {query(spark, sf_dir).count()}"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems) and name in sql
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - begun:.2f}s", *problems, sep="\n    " if problems else " ", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
