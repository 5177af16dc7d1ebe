"""Compare registered queries with their SQL equivalents: ``python tests/oracle_check.py DIR [name ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return f"{type(value).__name__}:{value}"


def sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted_rows(df.columns, df.collect())


def duck_rows(con, sql: str):
    result = con.execute(sql)
    return sorted_rows([d[0] for d in result.description], result.fetchall())


def difference(mine, theirs) -> str | None:
    """None when equal, else what differs first."""
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])} rows"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"first difference in {mine[0]}: {a} != {b}"
    return None


def main() -> None:
    from scorewatch.plans.catalog import QUERIES
    from scorewatch.plans.oracles import ORACLES
    from scorewatch.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            mine = spark_rows(QUERIES[name](spark, sf_dir))
            took = time.time() - start
            verdict = difference(mine, duck_rows(con, ORACLES[name])) if name in ORACLES else "no SQL"
        except Exception as error:  # noqa: BLE001
            mine, took, verdict = ([], []), time.time() - start, f"{type(error).__name__}: {str(error)[:700]}"
        bad += verdict not in (None, "no SQL")
        print(f"{'ok  ' if verdict is None else '----' if verdict == 'no SQL' else 'BAD '} {name:28s} {took:6.2f}s rows={len(mine[1])} {verdict or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
