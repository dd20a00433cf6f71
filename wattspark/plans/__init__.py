"""Registered queries over the given tables, each with its independent SQL."""

import importlib
import pkgutil

from wattspark.plans.registry import ORACLES, QUERIES

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.endswith("_queries")):
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["ORACLES", "QUERIES"]
