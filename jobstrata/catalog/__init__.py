"""Runnable queries over the test tables, each with the SQL it has to agree with."""

from __future__ import annotations

from importlib import import_module

MODULES = ["rules", "ingest", "relations", "aggregates", "streams", "stores"]


def load() -> dict:
    """All registered queries by name."""
    for module in MODULES:
        import_module(f"jobstrata.catalog.{module}")
    from jobstrata.catalog.base import REGISTRY

    return dict(REGISTRY)
