"""Run registered queries against their DuckDB oracles: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

import checks.families  # noqa: F401
from checks.derived import TABLES
from checks.registry import ORACLES, QUERIES
from estate.session import local_session


def cell(value) -> str:
    if isinstance(value, float):
        return f"{value:.10g}"
    return f"{type(value).__name__}:{value}"


def shape(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool | None, str]:
    frame = QUERIES[name](spark, sf_dir)
    columns, rows = shape(frame.columns, frame.collect())
    if name not in ORACLES:
        return None, f"{len(rows)} rows"
    answer = con.execute(ORACLES[name])
    want_columns, want = shape([d[0] for d in answer.description], answer.fetchall())
    if columns != want_columns:
        return False, f"columns {columns} != {want_columns}"
    if rows != want:
        extra, lacking = set(rows) - set(want), set(want) - set(rows)
        return False, f"{len(rows)} vs {len(want)} rows; only ours {sorted(extra)[:2]}; only oracle {sorted(lacking)[:2]}"
    return True, f"{len(rows)} rows"


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or QUERIES:
        started = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as fault:
            ok, note = False, f"{type(fault).__name__}: {str(fault)[:1500]}"
        bad += ok is False
        print(f"{'----' if ok is None else 'ok' if ok else 'FAIL'} {name} {time.time() - started:.2f}s {note}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
