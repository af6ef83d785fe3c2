"""Readers of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory, lazily."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
