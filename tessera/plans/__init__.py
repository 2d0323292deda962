"""Registered queries: each maps (spark, sf_dir) → DataFrame, most with a DuckDB SQL twin."""

from __future__ import annotations

from importlib import import_module

_GROUPS = ["linkage", "recommend", "classify", "cluster", "text"]


def _load():
    queries, sql = {}, {}
    for g in _GROUPS:
        m = import_module(f"tessera.plans.{g}")
        for k in m.QUERIES:
            if k in queries:
                raise ValueError(f"duplicate query {k}")
        queries.update(m.QUERIES)
        sql.update(m.SQL)
    return queries, sql


def all_queries():
    return _load()[0]


def all_sql():
    return _load()[1]
