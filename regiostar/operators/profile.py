"""Profiling reports. Unless said otherwise, each reads the table once or works on a reduced form of it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar import schema
from regiostar.operators.quantiles import column_quantiles, exact_quantiles, quantiles_of_counts, sketch_ends, value_counts
from regiostar.session import materialize


def _c(name: str):
    return F.col(f"`{name}`")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(_c(column)).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns as rows; each (column, value) is reduced before the shuffle."""
    listed = F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("value")) for c in columns])
    pairs = df.select(F.inline(listed)).distinct()
    return pairs.groupBy("column").agg(F.count("value").alias("distinct_values"))


def value_frequencies(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Values by descending count, the value breaking ties; with ``k`` only the first ``k``."""
    counts = df.filter(_c(column).isNotNull()).groupBy(_c(column)).agg(F.count("*").alias("rows"))
    ordered = counts.orderBy(F.desc("rows"), _c(column))
    return ordered if k is None else ordered.limit(k)


def null_report(df: DataFrame, warn_percent: float = schema.NULL_WARNING_PERCENT) -> DataFrame:
    """Null count and percentage per column, most first, with a flag above the warning level."""
    nulls = [F.count_if(_c(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    total = F.nullif(F.col("rows"), F.lit(0))
    listed = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("nulls"),
                (F.col(f"n{i}") * 100.0 / total).cast("double").alias("percent"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    report = df.agg(F.count("*").alias("rows"), *nulls).select(F.inline(listed))
    return report.select(
        "column", "nulls", F.round("percent", 2).alias("percent"), (F.col("percent") > warn_percent).alias("warning")
    ).orderBy(F.desc("nulls"), "column")


def column_info(df: DataFrame) -> DataFrame:
    """Type and non-null count per column."""
    counts = [F.count(_c(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    listed = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"n{i}").alias("non_null"))
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    return df.agg(*counts).select(F.inline(listed))


def yearly_pivot(df: DataFrame, year: str, column: str, measure: str, values: Sequence | None = None) -> DataFrame:
    """Sum of the measure by year with one column per value: per value present, or per given one, which saves a job."""
    return df.groupBy(_c(year)).pivot(column, None if values is None else list(values)).agg(F.sum(_c(measure)))


def outlier_bound(df: DataFrame, measure: str) -> DataFrame:
    """First and third quartile and the upper outlier bound, in one row."""
    quartiles = exact_quantiles(df, [], measure, [0.25, 0.75])
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    return quartiles.select(q1.alias("q1"), q3.alias("q3"), (q3 + 1.5 * (q3 - q1)).alias("upper_bound"))


def outlier_rows(df: DataFrame, measure: str) -> DataFrame:
    return df.filter(_c(measure) > outlier_bound(df, measure).select("upper_bound").scalar())


def outlier_report(df: DataFrame, measure: str) -> DataFrame:
    """Quartiles, bound, count and percentage of outliers; everything follows from one table of counts."""
    counts = materialize(df.groupBy(_c(measure).alias("value")).agg(F.count("*").alias("_count")), "value-counts")
    quartiles = quantiles_of_counts(counts.filter(F.col("value").isNotNull()), [], "value", [0.25, 0.75])
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    bounds = quartiles.select(q1.alias("q1"), q3.alias("q3"), (q3 + 1.5 * (q3 - q1)).alias("upper_bound"))
    bound = bounds.select("upper_bound").scalar()
    outliers = F.sum(F.when(F.col("value") > bound, F.col("_count")).otherwise(0))
    return counts.agg(
        bounds.select("q1").scalar().alias("q1"),
        bounds.select("q3").scalar().alias("q3"),
        bound.alias("upper_bound"),
        outliers.alias("outliers"),
        F.sum("_count").alias("total_rows"),
    ).withColumn("percent", F.round(F.col("outliers") * 100.0 / F.col("total_rows"), 2).cast("double"))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column.

    One scan gives the moments and a sketch of the quartiles of all columns, a second one counts the values around them.
    """
    chosen = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not chosen:
        raise ValueError("no numeric column to describe")
    quarters = [0.25, 0.5, 0.75]
    aggregates = []
    for i, name in enumerate(chosen):
        value = _c(name).cast("double")
        aggregates += [
            F.count(value).alias(f"count{i}"),
            F.avg(value).alias(f"mean{i}"),
            F.stddev_samp(value).alias(f"std{i}"),
            F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
            sketch_ends(value, quarters).alias(f"sketch{i}"),
        ]
    parts = ["count", "mean", "std", "min", "max", "sketch"]
    rows = [F.struct(F.lit(name).alias("column"), *[F.col(f"{x}{i}").alias(x) for x in parts]) for i, name in enumerate(chosen)]
    basics = materialize(df.agg(*aggregates).select(F.inline(F.array(*rows))), "column-moments")
    sketches = {row["column"]: (row["sketch"], row["count"]) for row in basics.select("column", "sketch", "count").collect()}
    quartiles = column_quantiles(df, sketches, quarters)
    q = F.col("quantiles")
    return basics.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min",
        q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), "max",
    )


def row_digest(columns: Sequence[str]) -> Column:
    """128 bits of a row in which nulls have a place of their own."""
    values = [_c(c) for c in columns]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return F.struct(
        F.xxhash64(nulls, *values).alias("a"), F.xxhash64(F.lit("second"), *reversed(values), nulls).alias("b")
    )


def duplicate_rows(df: DataFrame, digest: Callable[[Sequence[str]], Column] = row_digest) -> DataFrame:
    """Rows beyond the first of each set of equal rows; nulls count as equal.

    Digests are counted first; whole rows move only where a digest occurs more than once, to be compared as they are. The
    columns are read twice for this, and the rows counted once more.
    """
    columns = [f"_{i}" for i in range(len(df.columns))]
    rows = df.toDF(*columns)
    if not columns:
        counted = df.agg(F.count("*").alias("total_rows"))
        return counted.withColumn("duplicates", F.greatest(F.col("total_rows") - 1, F.lit(0)))
    key = digest(columns)
    digests = rows.groupBy(key["a"].alias("_a"), key["b"].alias("_b")).agg(F.count("*").alias("_copies"))
    repeated = materialize(digests.filter("_copies > 1").select("_a", "_b"), "repeated-digests")
    keyed = rows.withColumns({"_a": key["a"], "_b": key["b"]})
    groups = keyed.join(repeated, ["_a", "_b"], "left_semi").groupBy("_a", "_b", *columns).agg(F.count("*").alias("_copies"))
    surplus = groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"))
    return rows.agg(F.count("*").alias("total_rows")).select("total_rows", surplus.select("duplicates").scalar().alias("duplicates"))


def histogram(df: DataFrame, measure: str, cap: float = 50, bins: int = 50) -> DataFrame:
    """Equal-width bins over the values up to ``cap``; the last bin includes its upper edge.

    The rows are read once, into a table of value counts.
    """
    kept = df.filter(_c(measure) <= cap).select(_c(measure).cast("double").alias("value"))
    counts = value_counts(kept, [], "value")
    low, high = F.min("value"), F.max("value")
    single = low == high
    edges = counts.agg(
        F.when(single, low - 0.5).otherwise(low).alias("low"), F.when(single, high + 0.5).otherwise(high).alias("high")
    )
    placed = counts.select(
        "value",
        F.col("_count").alias("rows"),
        edges.select("low").scalar().alias("low"),
        edges.select("high").scalar().alias("high"),
    )
    bin_number = F.least(
        F.floor((F.col("value") - F.col("low")) * bins / (F.col("high") - F.col("low"))), F.lit(bins - 1)
    ).cast("int")
    width = (F.col("high") - F.col("low")) / bins
    return (
        placed.groupBy(bin_number.alias("bin"), "low", width.alias("width"))
        .agg(F.sum("rows").alias("rows"))
        .select(
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("from"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("to"),
            "rows",
        )
    )


def comma_count(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text holds a comma."""
    return df.agg(
        F.count("*").alias("total_rows"), F.count_if(_c(column).cast("string").contains(",")).alias("with_comma")
    )


def key_range(df: DataFrame, year: str, key: str) -> DataFrame:
    """Year range, row count and null share of a key."""
    nulls = F.count_if(_c(key).isNull())
    return df.agg(
        F.min(_c(year)).alias("first_year"),
        F.max(_c(year)).alias("last_year"),
        F.count("*").alias("total_rows"),
        nulls.alias("null_rows"),
        F.round(nulls * 100.0 / F.nullif(F.count("*"), F.lit(0)), 2).cast("double").alias("null_percent"),
    )


def geo_column(df: DataFrame, candidates: Sequence[str] = schema.GEO_CANDIDATES) -> str:
    """First candidate among the columns, whatever its case."""
    by_lower = {c.lower(): c for c in df.columns}
    for candidate in candidates:
        if candidate in by_lower:
            return by_lower[candidate]
    raise ValueError(f"no geographic column: looked for {list(candidates)} among {df.columns}")


def geo_key_audit(df: DataFrame) -> DataFrame:
    """Sorted distinct values of the geographic column."""
    column = geo_column(df)
    return (
        df.select(_c(column).cast("string").alias("value"))
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("value")
        .select(F.lit(column).alias("column"), "value")
    )


def preview(df: DataFrame, order: Sequence[str], k: int = 5) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order).limit(k)
