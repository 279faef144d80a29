"""Named queries and their DuckDB twins.

Every entry is ``name -> (function of a Warehouse, SQL text or None)``.
"""

from __future__ import annotations

import importlib

_MODULES = ("tables", "quality", "measures", "reports", "building_blocks", "maintenance")


def entries() -> dict:
    found: dict = {}
    for module in _MODULES:
        found.update(importlib.import_module(f"grainhouse.registry.{module}").QUERIES)
    return found
