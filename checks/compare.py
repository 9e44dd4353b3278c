"""Run queries next to their SQL on the same tables: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks.oracles import oracle_sql
from checks.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v) if not isinstance(v, float) else (True, "float", v) for v in row)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple(str(v) for v in _text(r)))


def _text(row):
    return tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in row)


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    got = QUERIES[name](spark, sf_dir)
    left_names, left = _rows(got.columns, [tuple(r) for r in got.collect()])
    cur = con.execute(oracle_sql()[name])
    right_names, right = _rows([c[0] for c in cur.description], cur.fetchall())
    out = []
    if left_names != right_names:
        return [f"columns {left_names} / {right_names}"]
    if len(left) != len(right):
        out.append(f"rows {len(left)} / {len(right)}")
    for a, b in zip(left, right):
        for n, x, y in zip(left_names, a, b):
            if type(x) is not type(y):
                out.append(f"type of {n}: {x!r} / {y!r}")
                return out
            if x != y and not (isinstance(x, float) and math.isnan(x) and math.isnan(y)):
                out.append(f"value of {n}: {a} / {b}")
                return out
    return out


def main(argv: list[str]) -> int:
    from millrace.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or [n for n in QUERIES if n in oracle_sql()]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'ok  ' if not found else 'DIFF'} {name} {time.time() - start:.1f}s {' | '.join(found)}", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
