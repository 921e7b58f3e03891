"""All queries of the library's own operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = [
    "longtrace.operators.scalar",
    "longtrace.operators.sequence",
    "longtrace.operators.joins",
    "longtrace.operators.aggregates",
    "longtrace.operators.merging",
    "longtrace.operators.matching",
    "longtrace.operators.classes",
    "longtrace.operators.splitting",
    "longtrace.operators.grid",
    "longtrace.operators.identity",
    "longtrace.operators.signals",
    "longtrace.operators.trajectories",
    "longtrace.operators.geometry",
    "longtrace.operators.units",
    "longtrace.streaming.streams",
    "longtrace.sources.queries",
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in import_module(m).QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in import_module(m).SQL.items()}
