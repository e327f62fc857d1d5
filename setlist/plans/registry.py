"""All registered queries on the driver's tables and their DuckDB oracles."""

from __future__ import annotations

import importlib

_MODULES = [
    "setlist.plans.recsys",
    "setlist.plans.etl",
    "setlist.plans.files",
    "setlist.plans.records",
    "setlist.plans.stored",
]


def _collect(attr: str) -> dict:
    out: dict = {}
    for name in _MODULES:
        mod = importlib.import_module(name)
        for k, v in getattr(mod, attr).items():
            if k in out:
                raise ValueError(f"query {k!r} registered twice")
            out[k] = v
    return out


def all_queries() -> dict:
    return _collect("QUERIES")


def all_oracles() -> dict:
    return _collect("ORACLES")
