"""The query catalogue: every query with its SQL twin where SQL can say it."""

from __future__ import annotations

from claimspark.plans import core_queries, core_sql, hierarchy_queries


def queries():
    out = {}
    for m in (core_queries, hierarchy_queries):
        out |= m.queries()
    return out


def oracle_sql():
    out = {}
    for m in (core_sql, hierarchy_queries):
        out |= m.oracle_sql()
    return out
