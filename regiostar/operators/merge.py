"""Yearly macro values attached to cohort rows, with year-median imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar import schema
from regiostar.functions.numbers import numeric
from regiostar.operators.fuzzy import apply_mapping, map_names
from regiostar.operators.quantiles import quantiles_of_counts
from regiostar.operators.sums import band_means, band_sums
from regiostar.session import materialize
from regiostar.sources.columns import require_columns

SUFFIX = "_api"


class NoRegionMatches(RuntimeError):
    """Not one macro region resembles a cohort region."""


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def with_macro_year(macro: DataFrame, year: str = schema.MACRO_YEAR) -> DataFrame:
    """Whole year; rows whose year is no finite number are dropped."""
    number = numeric(macro, year)
    finite = F.when(number.between(-1e9, 1e9), number)
    return macro.withColumn(year, F.floor(finite).cast("int")).dropna(subset=[year])


def sums_by_name(macro: DataFrame, year: str, region: str, values: Sequence[str]) -> DataFrame:
    """Sums and counts per (year, raw name): all that later steps need of the macro rows."""
    return band_sums(macro, {"year": F.col(f"`{year}`"), "raw": F.col(f"`{region}`").cast("string")}, values)


def means_by_region(
    sums: DataFrame, mapping: DataFrame, values: Sequence[str], types: Mapping[str, T.DataType]
) -> DataFrame:
    """Mean of each value per (year, canonical name), over all rows of all names that map to it.

    Sums are exact, so that the means do not depend on how rows are dealt out.
    """
    mapped = apply_mapping(sums, "raw", mapping, "region").filter(F.col("region").isNotNull())
    return band_means(mapped, ["year", "region"], values, types)


def annual_macro(
    macro: DataFrame,
    names: DataFrame,
    names_column: str,
    year: str = schema.MACRO_YEAR,
    region: str = schema.MACRO_REGION,
    values: Sequence[str] | None = None,
    threshold: float = schema.MATCH_THRESHOLD,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Name mapping and yearly means by canonical name.

    The macro rows are read once and reduced before any join. Without ``values``, every numeric
    column but the year is averaged, a numeric region code included.
    """
    require_columns(macro, [year, region], "macro")
    macro = with_macro_year(macro, year)
    chosen = list(values) if values is not None else sorted(numeric_columns(macro, exclude=[year]))
    sums = materialize(sums_by_name(macro, year, region, chosen), "macro-sums")
    mapping = materialize(map_names(sums, "raw", names, names_column, threshold), "name-mapping")
    types = {f.name: f.dataType for f in macro.schema.fields}
    if mapping.filter(F.col("canonical").isNotNull()).isEmpty():
        raise NoRegionMatches("no macro region matches a cohort region; lower the threshold or check the column")
    return mapping, means_by_region(sums, mapping, chosen, types), chosen


def group_medians(
    weighted: DataFrame, group: str, values: Sequence[str], weight: str, size: int | None = None
) -> DataFrame:
    """Median of each value per group, each row standing for ``weight`` rows. All values share one pass.

    ``size`` may give the rows of ``weighted``, which are counted otherwise.
    """
    listed = F.array(*[F.struct(F.lit(v).alias("column"), F.col(v).cast("double").alias("value")) for v in values])
    counts = (
        weighted.select(group, weight, F.inline(listed))
        .filter(F.col("value").isNotNull())
        .groupBy(group, "column", "value")
        .agg(F.sum(weight).alias("_count"))
    )
    if size is None:
        counts = materialize(counts, "median-counts")
    bound = None if size is None else size * len(values)
    middle = quantiles_of_counts(counts, [group, "column"], "value", [0.5], size=bound)
    medians = [F.max(F.when(F.col("column") == v, F.col("quantiles")[0])).alias(f"median_{v}") for v in values]
    return middle.groupBy(group).agg(*medians)


@dataclass
class MacroMerge:
    """Merged rows, and small tables by (year, region) that the audits read instead of the rows."""

    rows: DataFrame
    lookup: DataFrame
    mapping: DataFrame
    annual: DataFrame
    columns: list[str]

    def unmatched(self) -> DataFrame:
        """Rows without any macro value before imputation, and their percentage."""
        missing = F.sum(F.when(~F.col("matched"), F.col("rows")).otherwise(0))
        return self.lookup.agg(
            F.sum("rows").alias("total_rows"),
            missing.alias("unmatched_rows"),
            F.round(missing * 100.0 / F.nullif(F.sum("rows"), F.lit(0)), 2).alias("unmatched_percent"),
        )

    def top_unmatched(self, k: int = 10) -> DataFrame:
        """Regions with most unmatched rows; the name breaks ties."""
        return (
            self.lookup.filter(~F.col("matched") & F.col("region").isNotNull())
            .groupBy("region")
            .agg(F.sum("rows").alias("unmatched_rows"))
            .orderBy(F.desc("unmatched_rows"), "region")
            .limit(k)
        )

    def residual_nulls(self) -> DataFrame:
        """Nulls left in each macro column after imputation."""
        nulls = [F.sum(F.when(F.col(c).isNull(), F.col("rows")).otherwise(0)).alias(c) for c in self.columns]
        listed = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("residual_nulls")) for c in self.columns])
        return self.lookup.agg(*nulls).select(F.inline(listed))

    def coverage(self, column: str) -> DataFrame:
        """Share of rows with a matched value before imputation."""
        known = F.sum(F.when(F.col(f"raw_{column}").isNotNull(), F.col("rows")).otherwise(0))
        return self.lookup.agg(
            F.sum("rows").alias("total_rows"),
            known.alias("rows_with_value"),
            F.round(known * 100.0 / F.nullif(F.sum("rows"), F.lit(0)), 1).alias("percent"),
        )


def merge_macro(
    cohort: DataFrame,
    macro: DataFrame,
    year: str = schema.YEAR,
    region: str = schema.REGION,
    macro_year: str = schema.MACRO_YEAR,
    macro_region: str = schema.MACRO_REGION,
    values: Sequence[str] | None = None,
    threshold: float = schema.MATCH_THRESHOLD,
) -> MacroMerge:
    """Left-join cohort rows to yearly macro means; missing values take the median of their year.

    The median counts merged rows, not regions. As all rows of a (year, region) share one value, counts per (year,
    region) give it without the rows. Match and imputation therefore happen on the small table, and the
    rows are joined once, to the finished values. Years without any macro value stay null.
    """
    require_columns(cohort, [year, region], "cohort")
    counts = materialize(
        cohort.groupBy(F.col(year).alias("year"), F.col(region).alias("region")).agg(F.count("*").alias("rows")),
        "region-counts",
    )
    size = counts.count()
    if size == 0:
        raise RuntimeError("the cohort is empty, so the merge would be empty")
    mapping, annual, columns = annual_macro(
        macro, counts, "region", macro_year, macro_region, values, threshold
    )
    joined = counts.join(annual, ["year", "region"], "left")
    any_value = F.lit(False)
    for column in columns:
        any_value = any_value | F.col(column).isNotNull()
    medians = group_medians(joined, "year", columns, "rows", size)
    lookup = joined.withColumn("matched", any_value).join(medians, "year", "left")
    for column in columns:
        lookup = lookup.withColumnRenamed(column, f"raw_{column}").withColumn(
            column, F.coalesce(F.col(f"raw_{column}"), F.col(f"median_{column}").cast(annual.schema[column].dataType))
        )
    lookup = lookup.drop(*[f"median_{c}" for c in columns])
    lookup = materialize(lookup, "macro-lookup")
    final = [f"{c}{SUFFIX}" if c in cohort.columns else c for c in columns]
    values_by_key = lookup.select(
        F.col("year").alias("_year"),
        F.col("region").alias("_region"),
        *[F.col(c).alias(f) for c, f in zip(columns, final)],
    )
    same_key = F.equal_null(F.col(f"`{year}`"), F.col("_year")) & F.equal_null(F.col(f"`{region}`"), F.col("_region"))
    rows = cohort.join(values_by_key, same_key, "left").drop("_year", "_region")
    return MacroMerge(rows, lookup, mapping, annual, columns)
