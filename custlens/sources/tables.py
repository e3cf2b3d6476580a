"""Parquet table access for the driver's star schema.

Reads are lazy; column selection and filters applied downstream are
pushed into the parquet scan by Catalyst (``ReadSchema`` /
``PushedFilters`` in ``explain``), so callers never pay for columns
they do not use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df

