"""Sources and sinks.

* CSV is read with an explicit schema (no inference pass over the data).
* Sinks write through Spark writers; per-entity outputs are one table
  partitioned by the entity key, not one driver-written file per entity.
* JSON records for dashboards are built on executors (``to_json``) and
  only the small, already-aggregated payload is gathered into one row.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

# The warehouse DDL of the two source tables, as Spark types.
CUSTOMER_BASE_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("occupation_type", T.StringType()),
    T.StructField("monthly_income", T.DecimalType(12, 2)),
    T.StructField("open_account_date", T.StringType()),
    T.StructField("lifecycle_stage", T.StringType()),
    T.StructField("marriage_status", T.StringType()),
    T.StructField("city_level", T.StringType()),
    T.StructField("branch_name", T.StringType()),
])

CUSTOMER_BEHAVIOR_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("total_assets", T.DecimalType(16, 2)),
    T.StructField("deposit_balance", T.DecimalType(16, 2)),
    T.StructField("financial_balance", T.DecimalType(16, 2)),
    T.StructField("fund_balance", T.DecimalType(16, 2)),
    T.StructField("insurance_balance", T.DecimalType(16, 2)),
    T.StructField("asset_level", T.StringType()),
    T.StructField("deposit_flag", T.ByteType()),
    T.StructField("financial_flag", T.ByteType()),
    T.StructField("fund_flag", T.ByteType()),
    T.StructField("insurance_flag", T.ByteType()),
    T.StructField("product_count", T.IntegerType()),
    T.StructField("financial_repurchase_count", T.IntegerType()),
    T.StructField("credit_card_monthly_expense", T.DecimalType(12, 2)),
    T.StructField("investment_monthly_count", T.IntegerType()),
    T.StructField("app_login_count", T.IntegerType()),
    T.StructField("app_financial_view_time", T.IntegerType()),
    T.StructField("app_product_compare_count", T.IntegerType()),
    T.StructField("last_app_login_time", T.StringType()),
    T.StructField("last_contact_time", T.StringType()),
    T.StructField("contact_result", T.StringType()),
    T.StructField("marketing_cool_period", T.StringType()),
    T.StructField("stat_month", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV with a header row and an explicit schema."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_bank_tables(spark: SparkSession, base_path: str, behaviour_path: str):
    """S1 + S2: the two bank tables with their warehouse types; decimals are
    turned into doubles at the feature boundary, months stay 'yyyy-MM'."""
    base = read_csv(spark, base_path, CUSTOMER_BASE_SCHEMA)
    beh = read_csv(spark, behaviour_path, CUSTOMER_BEHAVIOR_SCHEMA)
    dec = [f.name for f in CUSTOMER_BEHAVIOR_SCHEMA.fields if isinstance(f.dataType, T.DecimalType)]
    beh = beh.withColumns({c: F.col(c).cast("double") for c in dec})
    base = base.withColumn("monthly_income", F.col("monthly_income").cast("double"))
    return base, beh


def stage_path(spark: SparkSession, name: str) -> str:
    """A folder for stage outputs under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "stages", name)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                header: bool = True) -> None:
    """Overwrite a table; ``partition_by`` gives one folder per
    entity value (e.g. one per selected customer)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", header)
    w.format(fmt).save(path)


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """S3: re-load a stage output."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(path)


def json_payloads(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The dashboard shape — per key one JSON array of row objects in a fixed
    order (the rows of a key are a report of bounded size)."""
    cols = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], F.struct(*cols).alias("record"))
    records = F.transform(F.array_sort(F.collect_list(rank)), lambda x: x["record"])
    return df.groupBy(*keys).agg(F.to_json(records).alias("payload"))


MODEL_VERSION = 1


def save_model(model, features: Sequence[str], spark: SparkSession, name: str) -> str:
    """Save a fitted Spark ML model under the shared folder, with the features it
    was fitted on, in their order, and a format version."""
    path = stage_path(spark, f"models/{name}")
    model.write().overwrite().save(f"{path}/model")
    about = [(MODEL_VERSION, f"{type(model).__module__}.{type(model).__name__}", list(features))]
    spark.createDataFrame(about, "version int, kind string, features array<string>").coalesce(1).write.mode("overwrite").json(f"{path}/about")
    return path


def load_model(spark: SparkSession, path: str):
    """(model, features) of a saved model; another format version is refused."""
    import importlib
    about = spark.read.schema("version int, kind string, features array<string>").json(f"{path}/about").first()
    if about["version"] != MODEL_VERSION:
        raise ValueError(f"{path}: saved as version {about['version']}, this is version {MODEL_VERSION}")
    module, _, kind = about["kind"].rpartition(".")
    if not module.startswith("pyspark.ml."):
        raise ValueError(f"{path}: not a Spark ML model")
    return getattr(importlib.import_module(module), kind).load(f"{path}/model"), list(about["features"])
