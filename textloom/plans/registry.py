"""Named queries over the benchmark tables and their DuckDB equivalents."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def queries() -> dict:
    from textloom.plans import queries as _  # noqa: F401
    return dict(QUERIES)


def oracle_sql() -> dict:
    from textloom.plans import queries as _  # noqa: F401
    return dict(ORACLES)
