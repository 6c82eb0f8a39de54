"""Run queries against their SQL on one data folder and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, query, sql, sf_dir) -> str | None:
    df = query(spark, sf_dir)
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {c[0]: str(c[1]) for c in result.description}
    odd = {f: (t, types[f]) for f, t in df.dtypes if KINDS.get(t) != types[f]}
    if odd:
        return f"types {odd}"
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows_of(names, result.fetchall())
    if not theirs:
        return "no rows to compare"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"{sorted(names)}: spark {a} != sql {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from bedhour.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    session = build_session(master="local[8]", shuffle_partitions=8, **{"spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    db = duck(folder)
    for key in wanted:
        start = time.time()
        if key not in entry.oracle_sql():
            print(f"{key}: no SQL, {entry.queries()[key](session, folder).count()} rows", round(time.time() - start, 2), flush=True)
            continue
        try:
            problem = compare(session, db, entry.queries()[key], entry.oracle_sql()[key], folder)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{key}: {problem or 'ok'}", round(time.time() - start, 2), flush=True)
