"""Registered queries: each binds operators to the given tables and has a check query."""

from __future__ import annotations

import importlib

MODULES = [
    "scalars", "hierarchy", "links", "validation", "packaging", "publishing", "media", "scans", "jobs",
]


def collect() -> tuple[dict, dict]:
    queries: dict = {}
    sqls: dict = {}
    for name in MODULES:
        module = importlib.import_module(f"{__name__}.{name}")
        overlap = set(queries) & set(module.QUERIES)
        assert not overlap, overlap
        queries.update(module.QUERIES)
        sqls.update(module.ORACLES)
    return queries, sqls
