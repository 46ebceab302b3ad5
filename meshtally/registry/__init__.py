"""Registered queries over the given tables."""

from __future__ import annotations


def registered() -> dict:
    from importlib import import_module
    out = {}
    for part in ("mesh", "vote", "index", "report", "live"):
        out.update(import_module(f"meshtally.registry.{part}_queries").QUERIES)
    return out
