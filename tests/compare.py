"""Compare registered queries with their SQL: python -m tests.compare FOLDER [NAME...]."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from winback.session import configure


def session(cores: str = "8") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("winback-tests")
    builder = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(
        tuple(repr(_plain(row[i])) for i in order) for row in rows
    )


def difference(con, found: DataFrame, sql: str) -> str | None:
    """None when columns, rows and values agree, else what differs."""
    got = _rows(found.columns, [tuple(r) for r in found.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra, missing = got[1] - want[1], want[1] - got[1]
        return (
            f"rows {got[1].total()} / {want[1].total()}; only here {extra.total()} "
            f"{list(extra)[:2]}; only in SQL {missing.total()} {list(missing)[:2]}"
        )
    return None if got[1] else "no rows"


def main() -> None:
    from winback.plans import all_queries, all_sql

    folder, names = sys.argv[1], sys.argv[2:]
    spark, con = session(), database(folder)
    queries, sql = all_queries(), all_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in sql:
                problem = difference(con, queries[name](spark, folder), sql[name])
            else:
                rows = len(queries[name](spark, folder).collect())
                problem = None if rows else "no rows"
        except Exception as error:  # a failing query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name}", flush=True)
        if problem:
            print("      " + problem, flush=True)
    print(f"{bad} of {len(names or queries)} differ", flush=True)


if __name__ == "__main__":
    main()
