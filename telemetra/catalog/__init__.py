"""Registered queries with their SQL checks, one module per area."""

from __future__ import annotations

import importlib

AREAS = ("landing", "columns", "fleet", "reports", "upkeep", "learning", "guides", "streams", "kept",
         "indexes")


def load_all() -> None:
    for area in AREAS:
        importlib.import_module(f"telemetra.catalog.{area}")
