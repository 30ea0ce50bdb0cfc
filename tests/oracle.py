"""Comparing a Spark result with DuckDB's, whatever the order of rows and columns."""

from __future__ import annotations


def _plain(v):
    if v is None or v != v:
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows_of(relation, names: list[str]) -> list[tuple]:
    return sorted((tuple(_plain(v) for v in r) for r in relation), key=repr)


def assert_same(df, connection, sql: str) -> int:
    names = sorted(df.columns)
    found = rows_of(df.select(*[f"`{n}`" for n in names]).collect(), names)
    relation = connection.sql(sql)
    assert sorted(relation.columns) == names
    order = [relation.columns.index(n) for n in names]
    assert found == rows_of(([r[i] for i in order] for r in relation.fetchall()), names)
    return len(found)
