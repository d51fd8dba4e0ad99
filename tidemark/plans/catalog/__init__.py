"""Named queries over the test tables, each with its SQL twin where one exists."""

from __future__ import annotations

from tidemark.plans.catalog import (  # noqa: F401
    aggregates,
    filters,
    forecasts,
    joins,
    scalars,
    scans,
    signals,
    streams,
    views,
    windows,
)
from tidemark.plans.catalog.base import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
