"""Compare registered queries with their SQL on one folder of test tables."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (datetime.date, int, str)):
        return value
    return float(value) if hasattr(value, "__float__") else str(value)


def ordered(columns: list[str], rows) -> list[tuple]:
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in place) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(con, sql: str, df) -> str | None:
    """None when equal, otherwise a description of the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = ordered(names, result.fetchall())
    actual = ordered(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(expected) != len(actual):
        return f"rows {len(actual)} != {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(bad)} of {len(actual)} rows differ, e.g. {bad[:2]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from halfstar.session import get_session

    spark = get_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "14g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, only = sys.argv[1], sys.argv[2:]
    con, sqls = connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                difference = compare(con, sqls[name], df)
                verdict = difference or "ok"
            else:
                verdict = f"rows only: {len(df.collect())}"
                difference = None
        except Exception as error:  # report every query, then fail at the end
            difference = verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += difference is not None
        print(f"{name:28s} {time.time() - start:7.2f}s  {verdict}", flush=True)
    print("failed:", failed)
