"""Exact quantiles (linear interpolation) over groups of any size."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiostar.operators.numbering import PART, part_offsets, ranged
from regiostar.session import materialize

# Up to this many distinct values one task may hold all counts of a group.
SINGLE_TASK_VALUES = 500_000
# Sketches err by at most one row in so many.
SKETCH_ACCURACY = 10_000
EVERYTHING = (-math.inf, math.inf)


def value_counts(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Non-null values with their frequencies, counted before the shuffle and written once."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count("*").alias("_count"))
    )
    return materialize(counts, "value-counts")


def quantiles_of_counts(
    counts: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    frequency: str = "_count",
    single_task_values: int = SINGLE_TASK_VALUES,
    size: int | None = None,
) -> DataFrame:
    """One row per group with an array of quantiles, from a table of values and frequencies.

    The table is counted first, so pass a written one, or an upper bound of its rows as ``size``.
    """
    if (counts.count() if size is None else size) <= single_task_values:
        at = F.array(*[F.lit(float(p)) for p in probabilities])
        return counts.groupBy(*group).agg(F.percentile(F.col(value), at, F.col(frequency)).alias("quantiles"))
    return _quantiles_by_rank(counts, group, value, probabilities, frequency)


def _quantiles_by_rank(counts, group, value, probabilities, frequency):
    """Global running counts over range partitions give each value the span of ranks it covers."""
    parts = ranged(counts, [*group, value])
    within = W.partitionBy(PART).orderBy(*group, value).rowsBetween(W.unboundedPreceding, W.currentRow)
    spans = parts.join(part_offsets(parts, F.sum(frequency)), PART).select(
        *group,
        F.col(value).cast("double").alias("_value"),
        (F.col("_before") + F.sum(frequency).over(within)).alias("_end"),
        F.col(frequency).alias("_n"),
    )
    spans = materialize(spans, "rank-spans")
    totals = spans.groupBy(*group).agg(
        F.min(F.col("_end") - F.col("_n")).alias("_first"), F.sum("_n").alias("_total")
    )
    if group:
        totals = totals.withColumnsRenamed({g: f"_of_{g}" for g in group})
        same = [F.equal_null(F.col(g), F.col(f"_of_{g}")) for g in group]
        spans = spans.join(totals, same).drop(*[f"_of_{g}" for g in group])
    else:
        spans = spans.select("*", F.lit(0).alias("_first"), totals.select("_total").scalar().alias("_total"))

    def at_rank(rank):
        covers = (rank >= F.col("_end") - F.col("_n")) & (rank < F.col("_end"))
        return F.max(F.when(covers, F.col("_value")))

    aggregates = []
    for i, p in enumerate(probabilities):
        place = F.lit(float(p)) * (F.col("_total") - 1)
        low = F.floor(place)
        aggregates += [
            at_rank(F.col("_first") + low).alias(f"_low{i}"),
            at_rank(F.col("_first") + F.ceil(place)).alias(f"_high{i}"),
            F.max(place - low).alias(f"_share{i}"),
        ]
    between = [
        F.col(f"_low{i}") * (1 - F.col(f"_share{i}")) + F.col(f"_high{i}") * F.col(f"_share{i}")
        for i in range(len(probabilities))
    ]
    return spans.groupBy(*group).agg(*aggregates).select(*group, F.array(*between).alias("quantiles"))


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probabilities: Sequence[float], **limits: int
) -> DataFrame:
    counts = value_counts(df, group, value)
    return quantiles_of_counts(counts, group, value, probabilities, **limits)


def brackets_of(sketch: Sequence[float | None] | None, rows: int) -> list[tuple[float, float]]:
    """Disjoint ascending ranges of values from the sketched ends of each; few rows need no narrowing."""
    if rows <= SKETCH_ACCURACY or not sketch:
        return [EVERYTHING]
    merged: list[tuple[float, float]] = []
    for low, high in sorted(zip(sketch[::2], sketch[1::2], strict=True)):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def sketch_ends(value: Column, probabilities: Sequence[float]) -> Column:
    """Approximate quantiles on both sides of each wanted one, three errors of the sketch apart from it."""
    reach = 3 / SKETCH_ACCURACY
    ends = [end for p in probabilities for end in (max(p - reach, 0.0), min(p + reach, 1.0))]
    return F.percentile_approx(F.nanvl(value, F.lit(None)), ends, SKETCH_ACCURACY)


def narrowed_counts(df: DataFrame, brackets: Mapping[str, Sequence[tuple[float, float]]]) -> DataFrame:
    """Frequencies of the values inside the brackets of each column; between two brackets all values make up one row.

    Columns: column, slot (odd inside a bracket, even between two, the last one NaN), value, _count. All columns share
    one scan, and each task sends the values inside brackets only.
    """
    listed = []
    for name, ranges in brackets.items():
        value = F.col(f"`{name}`").cast("double")
        slot = F.when(F.isnan(value), 2 * len(ranges) + 1)
        for i, (low, high) in enumerate(ranges):
            slot = slot.when(value < low, 2 * i).when(value <= high, 2 * i + 1)
        slot = slot.otherwise(2 * len(ranges))
        # Between brackets any edge keeps the order: no wanted rank falls there in the end.
        edges = F.array(*[F.lit(float(low)) for low, _ in ranges], F.lit(float(ranges[-1][1])))
        edge = F.get(edges, F.floor(slot / 2).cast("int"))
        kept = F.when(slot % 2 == 1, value).otherwise(edge)
        listed.append(F.when(value.isNotNull(), F.struct(F.lit(name).alias("column"), slot.alias("slot"), kept.alias("value"))))
    counts = (
        df.select(F.explode(F.filter(F.array(*listed), lambda x: x.isNotNull())).alias("x"))
        .groupBy("x.column", "x.slot", "x.value").agg(F.count("*").alias("_count"))
    )
    return materialize(counts, "narrowed-counts")


def _missed(slots: Sequence[Row], probabilities: Sequence[float]) -> set[str]:
    """Columns with a wanted rank between brackets."""
    missed, ends = set(), {}
    totals: dict[str, int] = {}
    for row in slots:
        totals[row["column"]] = totals.get(row["column"], 0) + row["rows"]
    for row in sorted(slots, key=lambda r: (r["column"], r["slot"])):
        name = row["column"]
        first = ends.get(name, 0)
        ends[name] = first + row["rows"]
        places = [p * (totals[name] - 1) for p in probabilities]
        wanted = {rank for place in places for rank in (math.floor(place), math.ceil(place))}
        if row["slot"] % 2 == 0 and any(first <= rank < ends[name] for rank in wanted):
            missed.add(name)
    return missed


def column_quantiles(
    df: DataFrame,
    sketches: Mapping[str, tuple[Sequence[float] | None, int]],
    probabilities: Sequence[float],
    **limits: int,
) -> DataFrame:
    """Exact quantiles per column (column, quantiles), from the sketched ends and row counts of an earlier pass.

    The sketch only says where to look. Exact counts tell whether every wanted rank lies inside a bracket; a column whose
    ranks do not, as a sketch may err and leaves out NaN, is read again without narrowing. NaN counts as the greatest value.
    """
    brackets = {name: brackets_of(*sketch) for name, sketch in sketches.items()}
    counts = narrowed_counts(df, brackets)
    missed = _missed(counts.groupBy("column", "slot").agg(F.sum("_count").alias("rows")).collect(), probabilities)
    if missed:
        again = narrowed_counts(df, {name: [EVERYTHING] for name in brackets if name in missed})
        counts = counts.filter(~F.col("column").isin(*missed)).unionByName(again)
    return quantiles_of_counts(counts, ["column"], "value", probabilities, **limits)
