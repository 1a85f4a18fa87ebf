"""Loads every query module so that its queries are registered."""

from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES, Query

MODULES = [
    "queries_matching",
    "queries_functions",
    "queries_projection",
    "queries_ordered",
    "queries_statistics",
    "queries_store",
    "queries_merging",
    "queries_signal",
    "queries_sizing",
    "queries_learning",
    "queries_files",
]


def load_catalog() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")
    return dict(QUERIES), dict(ORACLES)
