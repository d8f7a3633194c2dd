"""Compare a registered query with its SQL on the same parquet files."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time
import traceback
from collections import Counter

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, list):
        return tuple(plain(x) for x in v)
    return v


def compare(df, con, sql: str) -> list[str]:
    """Differences in names, types and rows; empty when equal."""
    names = sorted(df.columns)
    types = dict(df.dtypes)
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    if names != sorted(theirs):
        return [f"columns {names} and {sorted(theirs)}"]
    out = [
        f"type of {c}: {types[c]} and {theirs[c]}" for c in names if SPARK_TYPES.get(types[c], types[c]) != theirs[c]
    ]
    mine = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    order = [rel.columns.index(c) for c in names]
    other = Counter(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    if mine != other:
        out.append(
            f"rows: {sum(mine.values())} and {sum(other.values())}; only here {list((mine - other).items())[:3]}; "
            f"only there {list((other - mine).items())[:3]}"
        )
    return out


def main(sf: str, wanted: list[str]) -> int:
    import logging

    from modelwatch.catalog import ORACLES, QUERIES
    from modelwatch.session import build_session

    logging.disable(logging.WARNING)
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            diff = compare(df, con, ORACLES[name]) if name in ORACLES else [] if df.collect() else ["no rows"]
        except Exception:
            diff = [traceback.format_exc()[-1800:]]
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name:28s} {time.time() - start:6.2f}s {'' if name in ORACLES else '(rows only)'}", flush=True)
        for d in diff:
            print("    ", d, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
