"""Runs registered queries next to their SQL in DuckDB and compares the values.

    python tests/oracle.py [--sf DIR] [--cores N] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def table_of(names, rows):
    """Columns by name and rows as sorted texts."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    texts = [tuple(None if r[i] is None else normal(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(texts, key=repr)


FAMILY = {
    "bigint": "int", "int": "int", "integer": "int", "smallint": "int", "hugeint": "int",
    "string": "text", "varchar": "text", "double": "double", "boolean": "boolean",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp",
}


def compare(spark, con, sf, name, run, sql) -> str:
    df = run(spark, sf)
    got_cols, got = table_of(df.columns, df.collect())
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    if sql is None:
        return f"rows only: {len(got)}"
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]).lower() for d in cur.description}
    want_cols, want = table_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"DIFFERENT columns {got_cols} / {want_cols}"
    for c in got_cols:
        if types[c] in ("timestamp",) or FAMILY.get(types[c]) != FAMILY.get(want_types[c]):
            return f"DIFFERENT type of {c}: {types[c]} / {want_types[c]}"
    exact = [c for c in got_cols if types[c] != {"varchar": "string"}.get(
        want_types[c], {"integer": "int", "timestamp": "timestamp_ntz"}.get(
            want_types[c], want_types[c]))]
    if got != want:
        only = sorted(set(got) - set(want), key=repr)[:2]
        miss = sorted(set(want) - set(got), key=repr)[:2]
        return f"DIFFERENT rows {len(got)} / {len(want)}: {only} / {miss}"
    if not got:
        return "EMPTY"
    return f"ok {len(got)}" + (f" (width differs: {exact})" if exact else "")


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("--cores", default="8")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    import __spark_entry__ as entry
    from tidelog import session

    spark = session.build("tidelog-oracle", args.cores)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    runs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or sorted(runs):
        start = time.time()
        try:
            said = compare(spark, con, args.sf, name, runs[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            said = f"FAILED {type(e).__name__}: {str(e)[:1500]}"
        bad += not said.startswith(("ok", "rows"))
        print(f"{name:28s} {time.time() - start:6.1f}s  {said}", flush=True)
    print(f"{bad} not ok")
    spark.stop()


if __name__ == "__main__":
    main()
