"""Run registered queries in Spark and in DuckDB and compare them value by value.

    python tests/oracle.py [sf] [name prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> str | None:
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows {sum(got.values())} vs {sum(want.values())}\n    only spark: {str(extra)[:700]}\n    only duckdb: {str(missing)[:700]}"
    return None if got else "empty"


def main() -> int:
    import __spark_entry__ as entry
    from broadsheet.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = tuple(sys.argv[2:])
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.broadsheet.spread": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, bad = duck(sf_dir), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name, fn in queries.items():
        if wanted and not name.startswith(wanted):
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, fn, oracles[name], sf_dir)
            else:
                n = fn(spark, sf_dir).count()
                problem = None if n else "empty"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        seconds = time.time() - started
        if problem:
            bad += problem != "empty"
            print(f"{'EMPTY' if problem == 'empty' else 'FAIL '} {name} {seconds:.1f}s {problem}", flush=True)
        else:
            print(f"ok    {name} {seconds:.1f}s{'' if name in oracles else ' (rows only)'}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
