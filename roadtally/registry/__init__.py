"""Registered queries: each has a Spark form and, where SQL can express it, an equal SQL text."""

from __future__ import annotations

from importlib import import_module

TOPICS = ("places", "people", "measures", "cleaning", "derived", "filtered", "stored")


def all_queries() -> dict:
    """name -> (callable of spark and table folder, SQL text or None)."""
    out: dict = {}
    for topic in TOPICS:
        for name, query in import_module(f"roadtally.registry.{topic}").QUERIES.items():
            if name in out:
                raise ValueError(f"query {name!r} is registered twice")
            out[name] = query
    return out
