"""The query catalogue: importing the modules registers their queries."""

from __future__ import annotations

from . import catalog_aggs, catalog_blocks, catalog_commits, catalog_joins, catalog_loads, catalog_stage  # noqa: F401
from .registry import ORACLE, QUERIES


def all_queries() -> dict:
    return dict(QUERIES)


def all_oracle_sql() -> dict:
    return dict(ORACLE)
