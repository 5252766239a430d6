"""Registered queries and the SQL that checks them."""

from __future__ import annotations

import importlib
from types import ModuleType


def modules() -> list[ModuleType]:
    """Modules with ``QUERIES`` and ``ORACLE``; those of the optional text subpackage if it can be imported."""
    found = [importlib.import_module(f"tessera.queries.{n}") for n in ("training", "addresses", "places", "checks", "exports")]
    try:
        found.append(importlib.import_module("tessera.llm.queries"))
    except ModuleNotFoundError as e:
        if not (e.name or "").startswith("tessera.llm"):
            raise
    return found
