"""Runs a query and its oracle SQL on the same tables and compares the rows, order aside."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(v) -> str:
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


def rows(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    return names, sorted(tuple(_key(r[n]) for n in names) for r in table.to_pylist())


def compare(spark, con, name, query, sql, sf_dir) -> None:
    got = rows(query(spark, sf_dir).toArrow())
    want = rows(con.sql(sql).to_arrow_table())
    assert got[0] == want[0], f"{name}: columns {got[0]} and {want[0]}"
    assert len(got[1]) == len(want[1]), f"{name}: {len(got[1])} and {len(want[1])} rows"
    assert got[1] == want[1], f"{name}: {next((a, b) for a, b in zip(got[1], want[1], strict=True) if a != b)}"
