"""Run a query and its oracle on the same tables and compare their rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

FOLDER = Path("/root/testdata")


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    result = connection.execute(sql)
    return [column[0] for column in result.description], result.fetchall()


def _canonical(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)

    def value(v):
        return float(f"{v:.9g}") if isinstance(v, float) and math.isfinite(v) else v

    cells = [tuple(value(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(cells, key=repr)


def differences(df, sql: str, sf_dir: str) -> str | None:
    ours, theirs = _canonical(df.columns, [tuple(r) for r in df.collect()]), _canonical(*oracle_rows(sql, sf_dir))
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} and {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} and {len(theirs[1])} rows"
    for a, b in zip(ours[1], theirs[1], strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{dict(zip(ours[0], a))} and {dict(zip(ours[0], b))}"
    return None
