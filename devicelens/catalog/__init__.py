"""All registered queries."""

from __future__ import annotations

from devicelens.catalog import learning, series, storage, tabular
from devicelens.catalog.registry import ORACLES, QUERIES

__all__ = ["queries", "oracles", "learning", "series", "storage", "tabular"]


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
