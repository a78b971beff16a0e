"""The registered queries of the core engine and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from . import acquire_queries, corpus_queries, gate_queries, index_queries, layout_queries, mapping_queries, retrieval_queries, text_queries  # noqa: F401  registering them
from .registry import QUERIES, SQL


def queries() -> dict[str, Callable]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
