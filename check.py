"""Run registered queries next to their SQL twins and report differences.

    python check.py [--sf DIR] [key prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb

from streamgauge.catalog import all_oracles, all_queries
from streamgauge.catalog.adapters import TABLES
from streamgauge.session import build_session


def plain(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else (repr(value),)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return (type(value).__name__, str(value))


def rows_of(arrow):
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    return names, sorted(tuple(plain(v) for v in row) for row in zip(*columns))


def kinds_differ(spark_arrow, duck_arrow) -> dict:
    """Columns whose types differ between the engines though their values may not."""
    a = {f.name: str(f.type).replace("large_", "") for f in spark_arrow.schema}
    b = {f.name: str(f.type).replace("large_", "") for f in duck_arrow.schema}
    return {n: (a[n], b[n]) for n in a if n in b and a[n] != b[n]}


def compare(spark_arrow, duck_arrow) -> str | None:
    names, got = rows_of(spark_arrow)
    wanted_names, wanted = rows_of(duck_arrow)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    for a, b in zip(got, wanted):
        if a != b:
            return f"{names}\n   got    {a}\n   wanted {b}"
    return None


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    oracles = all_oracles()
    bad = 0
    for key, build in all_queries().items():
        if args.keys and not any(key.startswith(k) for k in args.keys):
            continue
        start = time.time()
        try:
            got = build(spark, args.sf).toArrow()
            took = time.time() - start
            if key in oracles:
                wanted = con.sql(oracles[key]).arrow()
                wanted = wanted.read_all() if hasattr(wanted, "read_all") else wanted
                problem = compare(got, wanted)
                if not problem and kinds_differ(got, wanted):
                    print("     types", key, kinds_differ(got, wanted))
            else:
                problem = None if got.num_rows else "no rows"
            state = "rows" if key not in oracles else "ok"
        except Exception as error:  # noqa: BLE001
            took, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'BAD' if problem else state:4} {key} {took:.2f}s {got.num_rows if not problem else problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
