"""Run queries next to their SQL oracle and compare the rows as multisets."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return names, result.fetchall()


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def _sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


def differences(names_a, rows_a, names_b, rows_b, limit: int = 5) -> list[str]:
    """Human-readable differences; empty if both results hold the same rows."""
    if sorted(names_a) != sorted(names_b):
        return [f"columns {sorted(names_a)} != {sorted(names_b)}"]
    a, b = _sorted_rows(names_a, rows_a), _sorted_rows(names_b, rows_b)
    if len(a) != len(b):
        return [f"{len(a)} rows != {len(b)} rows", f"first {a[:2]} / {b[:2]}"]
    found = []
    for x, y in zip(a, b):
        same = all(
            type(p) is type(q) and (p == q or (isinstance(p, float) and math.isnan(p) and math.isnan(q)))
            for p, q in zip(x, y)
        )
        if not same:
            found.append(f"{x} != {y}")
            if len(found) == limit:
                break
    return found
