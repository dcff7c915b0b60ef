"""Runs catalogue queries beside their SQL counterparts and compares the rows as bags."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def spark_bag(df: DataFrame) -> Counter:
    return _bag(df.columns, [tuple(r) for r in df.collect()])


def oracle_bag(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return columns, _bag(columns, result.fetchall())


def difference(spark: SparkSession, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both agree, else what differs."""
    df = query(spark, sf_dir)
    columns, wanted = oracle_bag(con, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    got = spark_bag(df)
    if got == wanted:
        return None
    surplus, lacking = got - wanted, wanted - got
    return (
        f"{sum(got.values())} rows instead of {sum(wanted.values())}; "
        f"surplus {list(surplus.items())[:2]}, lacking {list(lacking.items())[:2]}"
    )


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    from tidemark.session import clear_scratch, local_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con = local_session("8"), oracle_connection(sf_dir)
    failures = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            found = difference(spark, con, sf_dir, query, sql) if sql else f"no SQL, {query(spark, sf_dir).count()} rows"
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:900]}"
        failures += found is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {found or 'ok'}", flush=True)
    clear_scratch(spark)
    print(f"{failures} failures")


if __name__ == "__main__":
    main()
