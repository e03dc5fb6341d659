"""Runs registered queries and their SQL side by side.

Usage: python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and the SQL; empty if nothing does."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    wanted = sorted_rows(relation.fetchall(), names)
    found = sorted_rows(df.collect(), df.columns)
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(found) != len(wanted):
        return [f"{len(found)} rows, {len(wanted)} expected"]
    return [f"{a} != {b}" for a, b in zip(found, wanted, strict=True) if a != b]


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()

    import __spark_entry__ as spec
    from runatlas.session import get_spark

    spark = get_spark(
        "compare",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{options.sf}"
    con = connect(sf_dir)
    sql = spec.oracle_sql()
    bad = 0
    for name, run in spec.queries().items():
        if options.names and name not in options.names:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                found = differences(df, con, sql[name])
                state = "ok" if not found else f"DIFFERENT ({len(found)})"
            else:
                found, state = [], f"{df.count()} rows"
        except Exception as error:  # report and go on with the next query
            found, state = [str(error)[:1500]], "ERROR"
            if options.names:
                traceback.print_exc()
        bad += bool(found)
        print(f"{name:32} {time.time() - started:6.2f}s {state}", flush=True)
        for line in found[:3]:
            print("    ", line[:1500], flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
