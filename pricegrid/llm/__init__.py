"""Operators for large collections of training text, and their queries."""

from __future__ import annotations

from importlib import import_module

from .common import QUERIES, TWINS, Query


def all_queries() -> dict[str, Query]:
    import_module(f"{__name__}.queries")
    return dict(QUERIES)


def all_twins() -> dict[str, str]:
    import_module(f"{__name__}.queries")
    return dict(TWINS)
