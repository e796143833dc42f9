"""Compare every query with its SQL on the same tables: names, types, rows, values."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def family(kind: str) -> str:
    """A type name that both engines share."""
    kind = str(kind).lower()
    kind = {"varchar": "string", "integer": "int", "timestamp": "timestamp_ntz", "bool": "boolean"}.get(kind, kind)
    return kind.replace(", ", ",")


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when equal, else the first difference."""
    rel = con.sql(sql)
    ours = {f.name: family(f.dataType.simpleString()) for f in df.schema}
    theirs = {n: family(k) for n, k in zip(rel.columns, rel.types)}
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    kinds = {n: (ours[n], theirs[n]) for n in ours if ours[n] != theirs[n]}
    if kinds:
        return f"types {kinds}"
    names = sorted(ours)
    got = Counter(tuple(r[n] for n in names) for r in df.select(*names).collect())
    at = [rel.columns.index(n) for n in names]
    want = Counter(tuple(r[i] for i in at) for r in rel.fetchall())
    if got == want:
        return ""
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"{sum(extra.values())} extra {list(extra)[:2]}, {sum(missing.values())} missing {list(missing)[:2]}"
    )


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from rowflow.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions=os.environ.get("PARTITIONS", "8"), spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            diff = compare(run(spark, sf_dir), con, sql[name]) if name in sql else "no SQL"
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - began:.1f}s {diff}", flush=True)
    print(f"{bad} of {len(names) or len(queries())} differ")


if __name__ == "__main__":
    main()
