"""All registered queries with their oracle SQL."""

from __future__ import annotations

import importlib

GROUPS = ["aggregates", "cleaning", "features", "profiling", "sources", "batch", "models", "streaming"]


def _merged(name: str) -> dict:
    out: dict = {}
    for group in GROUPS:
        entries = getattr(importlib.import_module(f"marketloom.queries.{group}"), name)
        clash = out.keys() & entries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(entries)
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLES")
