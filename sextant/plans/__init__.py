"""Query bindings: every operator bound to the test tables, with its SQL oracle."""

from __future__ import annotations

from . import amount_queries, blend_queries, crossfit_queries, model_queries, orders_queries, score_queries, stage_queries, table_queries  # noqa: F401
from .base import REGISTRY


def queries():
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
