"""Registered queries over the driver tables and their SQL twins."""

from __future__ import annotations

from importlib import import_module

from .registry import QUERIES, TWINS, Query

_MODULES = ("landed", "records", "marts", "runs")


def _load() -> None:
    for name in _MODULES:
        import_module(f"{__name__}.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_twins() -> dict[str, str]:
    _load()
    return dict(TWINS)
