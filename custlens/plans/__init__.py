"""Registry of named plans (Spark builder + DuckDB oracle text)."""

from . import (basket_plans, bi_plans, explain_plans, features_plans,  # noqa: F401
               metrics_plans, model_plans, segment_plans, series_plans)
from . import dashboard_plans  # noqa: F401,E402  (built from the plans above)
from .registry import REGISTRY, Plan, plan


def queries():
    return {n: p.build for n, p in REGISTRY.items()}


def oracle_sql():
    return {n: p.sql for n, p in REGISTRY.items() if p.sql is not None}


__all__ = ["REGISTRY", "Plan", "plan", "queries", "oracle_sql"]
