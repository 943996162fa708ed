"""Queries over the driver tables, one per operator, each with its SQL counterpart."""

from importlib import import_module

MODULES = ["texts", "labels", "gates", "fields", "scoring", "quality", "dedup", "joins", "segment", "rollups", "retrieval", "sources", "sinks",
           "jobs", "streams"]


def load():
    queries, oracles = {}, {}
    for name in MODULES:
        m = import_module(f"{__name__}.{name}")
        for key, (fn, sql) in m.ENTRIES.items():
            assert key not in queries, key
            queries[key] = fn
            if sql is not None:
                oracles[key] = sql
    return queries, oracles
