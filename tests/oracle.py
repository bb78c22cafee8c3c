"""Compare a Spark query with its SQL counterpart in DuckDB, as sorted multisets of rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return "\0null"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"f{value:.9g}"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, name, f, sql, sf_dir, allow_empty=False):
    """None when equal, else a message."""
    df = f(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    theirs = {d[0]: str(d[1]) for d in result.description}
    odd = {c: (k, theirs[c]) for c, k in df.dtypes if KINDS.get(k) != theirs[c]}
    if odd:
        return f"types differ: {odd}"
    want = rows_of(names, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        return f"rows differ: {len(got)} / {len(want)}"
    if not want and not allow_empty:
        return "both results are empty"
    for a, b in zip(got, want):
        if a != b:
            return f"values differ: {str(a)[:400]} / {str(b)[:400]}"
    return None


def main():
    from tidemark.queries.registry import GROUPS
    from tidemark.queries import ORACLES, QUERIES
    from tidemark.session import build_session
    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                               "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, f in QUERIES.items():
        if wanted and not any(w in (name, GROUPS[name]) for w in wanted):
            continue
        began = time.time()
        try:
            if name in ORACLES:
                message = compare(spark, con, name, f, ORACLES[name], sf_dir)
            else:
                message = None if f(spark, sf_dir).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            message = f"{type(e).__name__}: {str(e)[:700]}"
        bad += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {time.time() - began:6.2f} {name} "
              f"{'' if name in ORACLES else '(no sql)'} {message or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
