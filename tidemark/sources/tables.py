"""Reading declared source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder (``<dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
