"""All registered queries of the hazard-exposure library with their SQL counterparts."""

from __future__ import annotations

import importlib

MODULES = ["impact_queries", "fire_queries", "asset_queries", "event_queries", "io_queries", "extra_queries", "shape_queries", "review_queries"]


def _merged(name: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(importlib.import_module(f"lahar.plans.{m}"), name)
    return out


def queries() -> dict:
    return _merged("Q")


def oracle_sql() -> dict[str, str]:
    return _merged("SQL")
