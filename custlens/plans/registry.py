"""Named query plans: each is a Spark builder plus an optional DuckDB
oracle text computing the same relation with independent SQL.

A plan reads the whole driver tables (or relations Spark derives from
them).  Output columns carry explicit aliases; doubles are rounded the
same way on both sides so results can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Plan:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    area: str


REGISTRY: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None, area: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate plan {name}")
        REGISTRY[name] = Plan(name, fn, sql, area)
        return fn
    return deco


def rnd(c, d: int = 6) -> Column:
    """Round half up to ``d`` decimals as floor(x * 10^d + 0.5) / 10^d —
    plain IEEE steps, so both engines round a given double identically;
    ``+ 0.0`` turns -0.0 into 0.0."""
    col = F.col(c) if isinstance(c, str) else c
    s = float(10 ** d)
    return (F.floor(col.cast("double") * F.lit(s) + F.lit(0.5)) / F.lit(s)).cast("double") + F.lit(0.0)


def rsql(expr: str, d: int = 6) -> str:
    s = f"{float(10 ** d)!r}"
    return f"(CAST(floor(CAST({expr} AS DOUBLE) * {s} + 0.5) AS DOUBLE) / {s} + 0.0)"
