"""Queries over the driver tables, one per operator, with the SQL each must agree with."""

from __future__ import annotations

import importlib

MODULES = ("metrics", "decision", "quality", "profiling", "featuring", "sources", "prep", "modelling", "evaluation", "explaining")


def load():
    """(queries, sql) of every check module."""
    from checks.registry import QUERIES, SQL

    for name in MODULES:
        importlib.import_module(f"checks.{name}")
    return dict(QUERIES), dict(SQL)
