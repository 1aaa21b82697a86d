"""Registered queries and multi-step plans."""

from __future__ import annotations


def _load() -> None:
    from . import signals, spatial, tabular, textual  # noqa: F401


def queries() -> dict:
    from .registry import QUERIES

    _load()
    return dict(QUERIES)


def oracle_sql() -> dict:
    from .registry import SQL

    _load()
    return dict(SQL)
