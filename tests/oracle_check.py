"""Runs catalogue plans next to their DuckDB oracle; usable from pytest and the shell."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    import datetime
    import decimal
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return None if math.isnan(v) else ("f", repr(v))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (bytes, bytearray)):
        return ("bytes", bytes(v))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return ("d", v.isoformat())
    return ("s", str(v))


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(df, con, sql):
    """None when equal, else a message."""
    order = sorted(df.columns)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != order:
        return f"columns {order} vs {sorted(names)}"
    idx = [names.index(c) for c in order]
    key = lambda t: repr(t)
    want = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=key)
    got = sorted((tuple(norm(r[c]) for c in order) for r in df.collect()), key=key)
    if len(want) != len(got):
        return f"rows spark={len(got)} oracle={len(want)} e.g. {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)}/{len(got)} rows differ {order}: {bad[0][0]} vs {bad[0][1]}"
    return None


def session(cpus: int = 8):
    from pyspark.sql import SparkSession
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("panelwright")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    return spark


def main(argv):
    import __spark_entry__ as e
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark, con = session(), duck(sf)
    qs, sqls, failed = e.queries(), e.oracle_sql(), []
    for name, fn in qs.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                msg = compare(df, con, sqls[name])
                if df.count() == 0:
                    msg = msg or "EMPTY"
            else:
                n = len(df.collect())
                msg = None if n else "no rows"
        except Exception as exc:  # noqa: BLE001
            msg = f"{type(exc).__name__}: {str(exc)[:600]}"
        took = time.time() - t
        print(f"{'ok  ' if msg is None else 'FAIL'} {name} {took:.1f}s {'' if name in sqls else '(rows)'} {msg or ''}", flush=True)
        if msg:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1:])
