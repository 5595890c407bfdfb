"""Runs registered queries beside their DuckDB SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}{'/*.parquet' if f.is_dir() else ''}'")
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    return names, found.fetchall()


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


def compare(df, sql: str, sf_dir: str) -> str | None:
    """What differs, or None."""
    names, expected = sql_rows(sql, sf_dir)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    a = sorted((tuple(_plain(r[n]) for n in order) for r in df.collect()), key=repr)
    b = sorted((tuple(_plain(r[names.index(n)]) for n in order) for r in expected), key=repr)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b, strict=False) if x != y][:2]
        return f"{len(a)} and {len(b)} rows, {diff}"
    return None
