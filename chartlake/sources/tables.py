"""Parquet tables of a data directory (lazy; Catalyst prunes columns and
pushes filters into the scan)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
