"""Parquet staging tables between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_staging(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
