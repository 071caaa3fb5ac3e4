"""Type inference for text columns, in one aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar import schema
from regiostar.functions.numbers import to_moment, to_number
from regiostar.session import small_methods


def _is_dated(name: str) -> bool:
    return any(word in name.lower() for word in schema.DATE_WORDS)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def column_evidence(df: DataFrame, distinct: bool = True) -> DataFrame:
    """One row per text column: rows, values, how many parse as number or date, distinct values."""
    small_methods(df.sparkSession)
    names = text_columns(df)
    counts = [F.count("*").alias("n_rows")]
    for i, name in enumerate(names):
        col = F.col(f"`{name}`")
        dated = F.count(to_moment(col)) if _is_dated(name) else F.lit(0).cast("long")
        counts += [
            F.count(col).alias(f"values{i}"),
            F.count(to_number(col)).alias(f"numbers{i}"),
            dated.alias(f"dates{i}"),
            (F.count_distinct(col) if distinct else F.lit(None).cast("long")).alias(f"distinct{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.col("n_rows").alias("n_rows"),
            F.col(f"values{i}").alias("n_values"),
            F.col(f"numbers{i}").alias("n_numbers"),
            F.col(f"dates{i}").alias("n_dates"),
            F.col(f"distinct{i}").alias("n_distinct"),
            F.lit(_is_dated(name)).alias("dated"),
        )
        for i, name in enumerate(names)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def inferred_types(df: DataFrame, distinct: bool = True) -> DataFrame:
    """Numbers first, then dates by name, then few distinct values."""
    numeric = (F.col("n_values") > 0) & (F.col("n_numbers") >= schema.NUMERIC_SHARE * F.col("n_values"))
    moment = F.col("dated") & (F.col("n_dates") == F.col("n_values"))
    category = F.col("n_distinct") < schema.CATEGORY_SHARE * F.col("n_rows")
    kind = F.when(numeric, "float").when(moment, "timestamp").when(category, "category").otherwise("string")
    return column_evidence(df, distinct).withColumn("inferred", kind).drop("dated")


def optimise_types(df: DataFrame) -> DataFrame:
    """Cast text columns by what they hold.

    Categories stay text, as Parquet encodes them by dictionary, so distinct values need no count here.
    """
    if not text_columns(df):
        return df
    kinds = {row["column"]: row["inferred"] for row in inferred_types(df, distinct=False).collect()}
    columns = []
    for name in df.columns:
        col = F.col(f"`{name}`")
        if kinds.get(name) == "float":
            col = to_number(col).cast("float").alias(name)
        elif kinds.get(name) == "timestamp":
            col = to_moment(col).alias(name)
        columns.append(col)
    return df.select(*columns)
