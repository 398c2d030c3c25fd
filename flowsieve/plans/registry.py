"""All registered queries and their SQL twins."""

from __future__ import annotations

from importlib import import_module

MODULES = ["eda", "history", "graph", "evaluation", "learning", "clusters", "streams"]


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        entries = getattr(import_module(f"flowsieve.plans.{name}"), attribute)
        clash = merged.keys() & entries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        merged.update(entries)
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("SQL")
