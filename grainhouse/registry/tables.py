"""Staging tables, dimensions and facts as queries."""

from __future__ import annotations

from grainhouse.sources.schemas import DWH_SCHEMAS, STG_SCHEMAS


def _declared(name: str):
    """Every declared column; ``fact_key`` is left out as its values are arbitrary."""
    return lambda wh: wh.declared(name).drop("fact_key")


QUERIES = {name: (_declared(name), f"SELECT * FROM {name}") for name in [*STG_SCHEMAS, *DWH_SCHEMAS]}
