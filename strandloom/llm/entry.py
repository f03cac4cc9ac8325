"""All queries of this subpackage by name, and their SQL."""

from __future__ import annotations

from strandloom.llm import corpus, hits, makeup

MODULES = (hits, corpus, makeup)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
