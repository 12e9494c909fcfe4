"""Run registered queries next to their SQL counterparts: ``python -m checks.compare DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from acreledger.session import build_session

from .oracle import oracles
from .queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(rows, names, digits=12):
    """Rows as a sorted list of tuples in column-name order; floats to 12 digits."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.{digits}g}") + 0.0
        return v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=lambda t: [(v is None, str(v)) for v in t])


def compare(spark, con, name, folder, sql):
    started = time.time()
    df = REGISTRY[name](spark, folder)
    raw = [tuple(r) for r in df.collect()]
    got = canonical(raw, df.columns)
    took = time.time() - started
    if sql is None:
        return f"rows {name} {len(got)} {took:.1f}s"
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    raw_want = cursor.fetchall()
    want = canonical(raw_want, names)
    if sorted(names) != sorted(df.columns):
        return f"DIFF {name} columns {sorted(df.columns)} against {sorted(names)}"
    if got != want:
        extra = [r for r in got if r not in want[:20000]][:2] if len(got) < 50000 else got[:2]
        missing = [r for r in want if r not in got[:20000]][:2] if len(want) < 50000 else want[:2]
        return f"DIFF {name} rows {len(got)} against {len(want)}\n   spark {extra}\n   sql   {missing}"
    exact = sum(g != w for g, w in zip(*(sorted(map(str, canonical(x, n, 17))) for x, n in ((raw, df.columns), (raw_want, names)))))
    kinds = {type(v).__name__ for r in got[:50] for v in r} ^ {type(v).__name__ for r in want[:50] for v in r}
    return f"same {name} {len(got)} {took:.1f}s {kinds or ''} {f'inexact={exact}' if exact else ''}"


def main(folder, *names):
    spark = build_session(
        "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                       "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    texts = oracles()
    for name in names or REGISTRY:
        try:
            print(compare(spark, con, name, folder, texts.get(name)), flush=True)
        except Exception as error:  # noqa: BLE001 - report and go on
            print(f"FAIL {name} {type(error).__name__} {str(error)[:400]}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
