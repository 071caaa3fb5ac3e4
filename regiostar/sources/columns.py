"""Checks on column names; all but ``column_report`` read metadata only and start no job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, required: Iterable[str], source: str) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise KeyError(f"{source}: missing columns {missing}; available are {df.columns}")
    return df


def column_report(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """A row per required column: column, present, n_values (not null; 0 if the column is missing), in one scan."""
    names = list(dict.fromkeys(required))
    missing = set(missing_columns(df, names))
    if not names:
        raise ValueError("no required column")
    counts = [F.count(F.lit(None) if name in missing else F.col(f"`{name}`")).alias(f"n{i}") for i, name in enumerate(names)]
    rows = [
        F.struct(F.lit(name).alias("column"), F.lit(name not in missing).alias("present"), F.col(f"n{i}").alias("n_values"))
        for i, name in enumerate(names)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])
