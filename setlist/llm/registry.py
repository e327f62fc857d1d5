"""The package's queries and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib

import corpus_pipeline

_MODULES = ["packing", "token_counts", "neighbours", "wrappers", "line_dedup", "sharding", "mixing", "simhash", "quality",
            "suffix_dedup", "url_rules", "manifest", "trie"]


def _collect(attr: str) -> dict:
    out: dict = {}
    for name in _MODULES:
        out |= getattr(importlib.import_module(f"setlist.llm.{name}"), attr)
    return out


def all_queries() -> dict:
    return _collect("QUERIES") | {"pipeline": corpus_pipeline.run}


def all_oracles() -> dict:
    return _collect("ORACLES") | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
