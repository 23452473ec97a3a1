"""Every registered query with the SQL it must agree with."""

from __future__ import annotations

from importlib import import_module

from tablewright.registry.common import Query

MODULES = ("profiles", "columns", "merges", "nesting", "storage", "flows")


def _registries():
    return [import_module(f"tablewright.registry.{m}").registry for m in MODULES]


def all_queries() -> dict[str, Query]:
    return {name: query for r in _registries() for name, query in r.queries.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for r in _registries() for name, sql in r.sql.items()}
