"""Queries over the test tables, one per operator."""

from __future__ import annotations

from types import ModuleType


def load_all() -> ModuleType:
    """The registry with every query module imported."""
    from fleetwatt.plans import registry
    from fleetwatt.plans import (  # noqa: F401
        check_queries,
        data_queries,
        feature_queries,
        forecast_queries,
        gap_queries,
        stat_queries,
        storage_queries,
    )

    return registry
