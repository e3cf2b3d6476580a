"""Dashboard datasets (D1–D6) and the source/sink round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import presets as ps
from ..functions.exact import exact_sum
from ..operators import bi
from ..sources import bindings as bd
from ..sources import io
from . import bi_plans as bp
from .registry import plan, rnd

# (dataset, plan, label column, value column) of each dashboard section
SECTIONS = [
    ("customer_distribution.segment_dist", "value_counts_segment", "occupation_type", "count"),
    ("customer_distribution.city_dist", "value_counts_region", "city_level", "count"),
    ("customer_distribution.income_dist", "income_histogram", "income_group", "count"),
    ("aum_trend", "monthly_aum_sum", "month", "total_assets"),
    ("asset_analysis.asset_level_dist", "asset_level_dist", "asset_level", "count"),
    ("asset_analysis.asset_composition", "asset_composition", "asset_type", "average_balance"),
    ("asset_analysis.asset_group_dist", "asset_histogram", "asset_group", "count"),
    ("behavior_analysis.app_login_trend", "app_login_trend", "month", "avg_login_count"),
    ("behavior_analysis.product_holding", "product_holding", "product_type", "count"),
]


def _decimal(c):
    return F.sum(F.col(c).cast("decimal(38,2)"))


def _asset_sections(spark, sf):
    """aum_trend and asset_analysis, product_holding: customer-months become one
    row per (month, level), then grouping sets over those few rows."""
    b = bd.behaviour(spark, sf).withColumn("asset_level", bi.level_ladder("total_assets", ps.DRIVER_LEVEL_EDGES, ps.DRIVER_LEVEL_LABELS))
    band, bands = bi.bin_index("total_assets", ps.DRIVER_ASSET_EDGES), range(len(ps.DRIVER_ASSET_LABELS))
    money = ["total_assets", *bd.BALANCES]
    cells = b.groupBy("stat_month", "asset_level").agg(
        F.count(F.lit(1)).alias("n"), *[_decimal(c).alias(c) for c in money], *[F.count(c).alias(f"n_{c}") for c in bd.BALANCES],
        *[F.sum(c).alias(c) for c in bd.FLAGS], *[F.count_if(band == i).alias(f"band_{i}") for i in bands])
    measures = {c: F.sum(c) for c in ("n", *money, *[f"n_{c}" for c in bd.BALANCES], *bd.FLAGS, *[f"band_{i}" for i in bands])}
    sets = {"stat_month": [("aum_trend", rnd(F.col("total_assets").cast("double") * F.lit(1e-4), 4))],
            "asset_level": [("asset_analysis.asset_level_dist", F.col("n"))]}
    whole = [("asset_analysis.asset_composition", F.lit(ps.DRIVER_BALANCE_LABELS[c]), rnd(F.col(c).cast("double") / F.col(f"n_{c}"), 4))
             for c in bd.BALANCES]
    whole += [("behavior_analysis.product_holding", F.lit(ps.DRIVER_FLAG_LABELS[c]), F.col(c)) for c in bd.FLAGS]
    whole += [("asset_analysis.asset_group_dist", F.lit(ps.DRIVER_ASSET_LABELS[i]), F.col(f"band_{i}")) for i in bands]
    return bi.dashboard_rows(cells, sets, whole, measures)


def _customer_sections(spark, sf):
    """customer_distribution: grouping sets over one row per (segment, region)."""
    band, bands = bi.bin_index("monthly_income", ps.DRIVER_INCOME_EDGES), range(len(ps.DRIVER_INCOME_LABELS))
    cells = bd.base(spark, sf).groupBy("occupation_type", "city_level").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(band == i).alias(f"band_{i}") for i in bands])
    sets = {"occupation_type": [("customer_distribution.segment_dist", F.col("n"))],
            "city_level": [("customer_distribution.city_dist", F.col("n"))]}
    whole = [("customer_distribution.income_dist", F.lit(ps.DRIVER_INCOME_LABELS[i]), F.col(f"band_{i}")) for i in bands]
    return bi.dashboard_rows(cells, sets, whole, {c: F.sum(c) for c in ("n", *[f"band_{i}" for i in bands])})


def _sections(spark, sf):
    """Every section; orders, customers and events are scanned once each."""
    logins = bp.app_login_trend(spark, sf).select(F.lit("behavior_analysis.app_login_trend").alias("dataset"), F.col("month").alias("label"),
                                                  F.col("avg_login_count").cast("double").alias("value"))
    return _asset_sections(spark, sf).unionByName(_customer_sections(spark, sf)).unionByName(logins)


def _bundle_sql():
    from .registry import REGISTRY
    return "\nUNION ALL\n".join(
        f"SELECT '{ds}' AS dataset, CAST({lab} AS VARCHAR) AS label, CAST({val} AS DOUBLE) AS value "
        f"FROM ({REGISTRY[name].sql}) x" for ds, name, lab, val in SECTIONS)


@plan("dashboard_bundle", _bundle_sql(), "dashboard")
def dashboard_bundle(spark, sf):
    """Every dashboard section as (dataset, label, value) rows."""
    return _sections(spark, sf)


def _json_sql():
    # 15 digits of a double are the same text in both engines once a number is rounded
    return f"""
SELECT dataset, '[' || string_agg('{{"label":' || to_json(label) || ',"value":"' || CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) || '"}}', ','
                                  ORDER BY label) || ']' AS payload
FROM ({_bundle_sql()}) x GROUP BY dataset"""


@plan("dashboard_json", _json_sql(), "dashboard")
def dashboard_json(spark, sf):
    """S6 + D1–D5: one JSON array of records per dashboard section, records in the
    order of their labels."""
    s = _sections(spark, sf).withColumn("value", F.col("value").cast("decimal(18,4)").cast("string"))
    return io.json_payloads(s, ["dataset"], ["label"])


STAGE_SQL = f"""
SELECT CAST(substr(stat_month, 1, 4) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CAST(total_assets AS DECIMAL(38,2))) AS DOUBLE) AS total_assets
FROM ({bd.BEHAVIOUR_SQL}) b GROUP BY 1
"""


@plan("stage_roundtrip", STAGE_SQL, "io")
def stage_roundtrip(spark, sf):
    """S1 + S3 + S4 + S5: write the behaviour table as CSV (header,
    partitioned by year) to the shared stage folder, read it back with an
    explicit schema, and count rows and assets per year."""
    b = bd.behaviour(spark, sf).withColumn("year", F.substring("stat_month", 1, 4))
    path = io.stage_path(spark, f"behaviour-csv-{uuid.uuid4().hex}")
    io.write_table(b, path, "csv", partition_by=["year"])
    schema = T.StructType([f for f in b.schema.fields if f.name != "year"])
    back = io.read_stage(spark, path, "csv", schema)
    return back.groupBy("year").agg(F.count(F.lit(1)).cast("long").alias("rows"),
                                    exact_sum("total_assets").alias("total_assets"))
