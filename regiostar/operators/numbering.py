"""Dense numbers in key order without sending a large table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiostar.session import materialize

# Up to this many rows one task may sort the whole table.
SINGLE_TASK_ROWS = 200_000

PART = "_part"
POSITION = "_position"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def ranged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` sorted over range partitions, written, with partition and zero-based position of each row.

    It is written because range bounds come from a sample: reading it twice must give the same parts.
    """
    position = F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    parts = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias(PART), position.alias(POSITION))
    )
    return materialize(parts, "ranged")


def part_offsets(parts: DataFrame, amount: Column) -> DataFrame:
    """Sum of ``amount`` over all earlier parts: one row per shuffle partition, so small by construction."""
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    totals = parts.groupBy(PART).agg(amount.alias("_amount"))
    return F.broadcast(
        totals.select(PART, F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_before"))
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    start: int = 0,
    single_task_rows: int = SINGLE_TASK_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Add ``start + 1 ..`` in the order of ``keys``.

    ``df`` is read twice unless its number of rows is given, so pass a written table.
    """
    if (df.count() if rows is None else rows) <= single_task_rows:
        number = F.row_number().over(W.orderBy(*keys)) + F.lit(start)
        return df.select(number.cast("int").alias(name), "*")
    parts = ranged(df, keys)
    numbered = parts.join(part_offsets(parts, F.count("*")), PART)
    number = F.col("_before") + F.col(POSITION) + F.lit(start + 1)
    return numbered.select(number.cast("int").alias(name), *df.columns)
