"""Sums of doubles that do not depend on the order of rows or tasks.

Adding doubles rounds at every step, so reruns may differ in the last digit. Here values are sorted into bands of 32 binary
orders of magnitude; in its band a value is a whole number, and decimals add whole numbers without rounding. Bands are put
together in ascending order at the end. Every band holds up to 6e11 values of its largest size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Binary orders in a band, binary digits kept below it, and the bands that doubles reach without overflow of the scale.
WIDTH, DIGITS, LOWEST, HIGHEST = 32, 54, -960, 992


def _finite(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def _band(value: Column) -> Column:
    band = F.floor(F.log2(F.abs(value)) / WIDTH).cast("int") * WIDTH
    return F.when(value == 0, 0).otherwise(F.least(F.greatest(band, F.lit(LOWEST)), F.lit(HIGHEST)))


def _scale(band: Column, sign: int) -> Column:
    """An exact power of two."""
    return F.pow(F.lit(2.0), sign * (band - DIGITS))


def band_sums(df: DataFrame, keys: Mapping[str, Column], values: Sequence[str]) -> DataFrame:
    """Rows of (keys, column, band, part, beyond, n): ``part`` sums finite values, ``beyond`` infinite ones and NaN."""
    listed = [F.struct(F.lit(v).alias("column"), F.col(f"`{v}`").cast("double").alias("value")) for v in values]
    if not listed:
        listed = [F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("double").alias("value"))]
    long = df.select(*[c.alias(k) for k, c in keys.items()], F.inline(F.array(*listed)))
    banded = long.withColumn("finite", _finite(F.col("value"))).withColumn("band", _band(F.col("finite")))
    whole = (F.col("finite") * _scale(F.col("band"), -1)).cast("decimal(28,0)")
    return banded.groupBy(*keys, "column", "band").agg(
        F.sum(whole).alias("part"),
        F.sum(F.when(F.col("finite").isNull(), F.col("value"))).alias("beyond"),
        F.count("value").alias("n"),
    )


def band_means(sums: DataFrame, keys: Sequence[str], values: Sequence[str], types: Mapping[str, T.DataType]) -> DataFrame:
    """Mean of each value per key, from rows of ``band_sums``; a 32-bit float column gives 32-bit means."""
    bands = sums.groupBy(*keys, "column", "band").agg(
        F.sum("part").cast("decimal(38,0)").alias("part"), F.sum("beyond").alias("beyond"), F.sum("n").alias("n")
    )
    ascending = F.sort_array(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("band", "part"))))
    total = F.aggregate(
        ascending, F.lit(0.0), lambda sum_, x: sum_ + x["part"].cast("double") * _scale(x["band"], 1)
    )
    per_column = bands.groupBy(*keys, "column").agg(
        ((total + F.coalesce(F.sum("beyond"), F.lit(0.0))) / F.nullif(F.sum("n"), F.lit(0))).alias("mean")
    )
    means = [
        F.max(F.when(F.col("column") == v, F.col("mean")))
        .cast("float" if isinstance(types[v], T.FloatType) else "double")
        .alias(v)
        for v in values
    ]
    return per_column.groupBy(*keys).agg(*means) if means else per_column.select(*keys).distinct()
