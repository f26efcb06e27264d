"""Queries over the driver's tables, one per operator, grouped by area."""

from __future__ import annotations

import importlib

AREAS = ("sequence_queries", "diff_queries", "quality_queries", "reconcile_queries", "store_queries", "ingest_queries", "publish_queries", "hierarchy_queries")


def load():
    """All registered queries and oracle texts."""
    from driftlens.queries import registry

    for area in AREAS:
        importlib.import_module(f"driftlens.queries.{area}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
