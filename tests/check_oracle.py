"""Run catalogue queries next to their DuckDB twins: ``check_oracle.py sf_dir [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float) and math.isfinite(v) and v == int(v) and abs(v) < 2**53:
            return str(int(v))
        return "\0null" if v is None else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, fn, sql: str) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = canonical(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return False, f"{len(got)} rows and {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w:
            return False, f"first difference\n   {str(g)[:600]}\n   {str(w)[:600]}"
    return True, f"{len(got)} rows"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from uttermill.session import build_session

    sf_dir, wanted = argv[0], argv[1:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    sqls = oracle_sql()
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                ok, note = compare(spark, con, sf_dir, fn, sqls[name])
            else:
                ok, note = True, f"{fn(spark, sf_dir).count()} rows, no SQL"
        except Exception as err:
            ok, note = False, f"{type(err).__name__}: {str(err)[:900]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
