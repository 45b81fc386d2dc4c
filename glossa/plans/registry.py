"""Registry of named queries: a Spark builder plus (optionally) its DuckDB oracle SQL.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
parquet tables of ``sf_dir``. The oracle is plain SQL over the same tables
(fixture views are prepended as CTEs), used by the correctness gate.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    covers: str


_QUERIES: dict[str, Query] = {}


def register(name: str, *, covers: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = Query(name, fn, oracle, covers)
        return fn

    return deco


def oracle_of(name: str) -> str:
    """Oracle SQL of an already registered query (to build a derived oracle on it)."""
    return _QUERIES[name].oracle


def all_queries() -> dict[str, Query]:
    # Import the plan modules for their registration side effect.
    from glossa.plans import (  # noqa: F401
        dirty_plans,
        landing_plans,
        marts_plans,
        ml_plans,
        quality_plans,
        report_plans,
        rule_plans,
        segment_plans,
        social_plans,
        stats_plans,
        stream_plans,
        text_plans,
        tweet_plans,
        watch_plans,
    )

    return dict(_QUERIES)


def rnd(expr: str, places: int) -> str:
    """DuckDB spelling of half-even rounding on the scaled float (Spark: rint(x*10^p)/10^p)."""
    return f"(round_even(({expr}) * {float(10**places)}, 0) / {float(10**places)})"


def r3(expr: str) -> str:
    return rnd(expr, 3)


def r9(expr: str) -> str:
    return rnd(expr, 9)


def savg(expr: str) -> str:
    """DuckDB spelling of ``stable_avg``."""
    return f"(CAST(sum(CAST({expr} AS DECIMAL(38,12))) AS DOUBLE) / count({expr}))"


def ssum(expr: str) -> str:
    """DuckDB spelling of ``stable_sum``."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,12))) AS DOUBLE)"
