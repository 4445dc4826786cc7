"""Registered queries over the given tables, with their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

from .registry import ORACLES, QUERIES, Query

MODULES = ["cells", "partitions", "matches", "ingest", "figures", "streams"]


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return dict(QUERIES), dict(ORACLES)
