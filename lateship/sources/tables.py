"""Readers for the base Parquet tables.

Every reader projects to the columns it needs, so the Parquet scan's
``ReadSchema`` stays narrow; filters added later are pushed down by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df
