"""All reference-side queries and their SQL, gathered from the operator modules."""

from __future__ import annotations

import importlib
from collections.abc import Callable

FLAGSHIP = "join01_source_matching"
MODULES: tuple[str, ...] = ("scalars", "matching", "relational", "graph", "vectors", "ann", "works", "project", "evaluation", "records", "projections", "events")


def _gather(name: str) -> dict:
    found: dict = {}
    for m in MODULES:
        found |= getattr(importlib.import_module(f"varqa.operators.{m}"), name)
    return found


def queries() -> dict[str, Callable]:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("ORACLE")
