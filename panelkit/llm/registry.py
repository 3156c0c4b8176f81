"""Name -> query and name -> oracle SQL of the document operators."""

from __future__ import annotations

from panelkit.llm import oracle, queries


def query_functions() -> dict:
    return {n: f for n, f in vars(queries).items() if n.startswith("op") and n[2].isdigit()}


def oracle_sql() -> dict:
    return dict(oracle.SQL)
