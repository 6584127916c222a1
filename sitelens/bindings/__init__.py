"""The operators bound to the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

from sitelens.bindings.registry import QUERIES, SQL, Query

MODULES = ("relational", "cohorts", "checks", "processing", "publication", "medication")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"sitelens.bindings.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
