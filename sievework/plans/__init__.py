"""The catalogue of queries over the tables, each with its SQL where there is one."""

from __future__ import annotations

from importlib import import_module

from .base import Plans

MODULES = ("text", "vocabulary", "counts", "joins", "matching", "chemistry", "learning", "assembled", "dedupe", "quality", "features", "sources", "review", "cues", "fields", "names", "walks")


def plans() -> Plans:
    """name -> (query, SQL or None)."""
    out: Plans = {}
    for name in MODULES:
        own: Plans = import_module(f".{name}", __name__).PLANS
        if twice := out.keys() & own.keys():
            raise ValueError(f"registered twice: {sorted(twice)}")
        out |= own
    return out
