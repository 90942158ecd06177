"""All registered queries of the library and their SQL oracles."""

from __future__ import annotations

from helixframe.plans import registry


def queries():
    return {name: q.run for name, q in registry.all_queries().items()}


def oracle_sql():
    return {name: q.sql for name, q in registry.all_queries().items() if q.sql}
