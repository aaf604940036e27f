"""Named queries, one module per operator family."""

import importlib

from worklode.queries.registry import REGISTRY, callables, sql_texts

for _module in ("marts", "relational", "quality", "state", "text", "graph", "exchange", "streams", "warehouse"):
    importlib.import_module(f"worklode.queries.{_module}")

__all__ = ["REGISTRY", "callables", "sql_texts"]
