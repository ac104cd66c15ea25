"""Registered queries, each with its DuckDB counterpart where SQL can state it."""

import importlib

from docloom.plans.registry import ORACLES, QUERIES

for _module in ("collections", "census", "schemas", "relational", "mappings", "texts", "streams"):
    importlib.import_module(f"docloom.plans.{_module}")

__all__ = ["ORACLES", "QUERIES"]
