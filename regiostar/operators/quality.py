"""Data-quality rules, evaluated together in one aggregate job."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostar import schema

SAMPLE_SIZE = 20


class QualityGateError(ValueError):
    """At least one rule failed."""


@dataclass(frozen=True)
class Rule:
    """Share of unexpected values among the non-null values of a column, against a tolerance."""

    name: str
    column: str | None
    kwargs: dict = field(default_factory=dict, hash=False)

    @property
    def mostly(self) -> float:
        return self.kwargs.get("mostly", 1.0)

    @property
    def col(self) -> Column:
        return F.col(f"`{self.column}`")

    @property
    def counts_nulls(self) -> bool:
        return self.name == "not_null"

    def unexpected(self) -> Column:
        """Condition for a value that breaks the rule; never true of a null, except for ``not_null``."""
        col, k = self.col, self.kwargs
        if self.name == "not_null":
            return col.isNull()
        if self.name == "in_set":
            return ~col.isin(*k["value_set"])
        if self.name == "between":
            low, high = k.get("min_value"), k.get("max_value")
            bounds = [] if low is None else [col < low]
            bounds += [] if high is None else [col > high]
            return reduce(lambda a, b: a | b, bounds, F.lit(False))
        if self.name == "max_length":
            return F.length(col) > k["value"]
        if self.name == "fits_decimal":
            precision, scale = k["precision"], k["scale"]
            return col.isNotNull() & col.try_cast(f"decimal({precision},{scale})").isNull()
        raise ValueError(f"unknown rule {self.name}")


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> Rule:
    return Rule("in_set", column, {"value_set": list(values), "mostly": mostly})


def between(column: str, low=None, high=None, mostly: float = 1.0) -> Rule:
    return Rule("between", column, {"min_value": low, "max_value": high, "mostly": mostly})


def row_count_between(low: int | None, high: int | None) -> Rule:
    return Rule("row_count_between", None, {"min_value": low, "max_value": high})


def max_length(column: str, length: int) -> Rule:
    return Rule("max_length", column, {"value": length})


def fits_decimal(column: str, precision: int, scale: int) -> Rule:
    return Rule("fits_decimal", column, {"precision": precision, "scale": scale})


def standard_suite(
    year: str = schema.YEAR,
    code: str = "codigo_departamento",
    sector: str = schema.SECTOR,
    stratum: str = schema.STRATUM,
    measure: str = schema.MEASURE,
    min_rows: int = schema.MIN_ROWS,
    max_rows: int = schema.MAX_ROWS,
) -> list[Rule]:
    """The six rules of the gate; column names and row bounds can be set."""
    return [
        not_null(year),
        not_null(code),
        in_set(sector, schema.ALLOWED_SECTORS),
        in_set(stratum, schema.ALLOWED_STRATA, mostly=schema.STRATUM_TOLERANCE),
        between(measure, low=0),
        row_count_between(min_rows, max_rows),
    ]


def table_constraints(with_macro: bool = True) -> list[Rule]:
    """Not-null, length and precision limits of the tables' columns."""
    rules = []
    for f in schema.COHORT_FIELDS:
        if f.required:
            rules.append(not_null(f.name))
        if f.max_length:
            rules.append(max_length(f.name, f.max_length))
    if with_macro:
        rules.append(fits_decimal(schema.MACRO_VALUE, 15, 4))
    return rules


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with counts, percentages and success, from a single scan."""
    counts = [F.count("*").alias("rows")]
    for i, rule in enumerate(rules):
        if rule.column is not None:
            counts.append(F.count_if(rule.unexpected()).alias(f"bad{i}"))
            counts.append(F.count(rule.col).alias(f"known{i}"))
    results = []
    for i, rule in enumerate(rules):
        rows = F.col("rows")
        if rule.column is None:
            low, high = rule.kwargs["min_value"], rule.kwargs["max_value"]
            success = F.lit(True)
            success = success if low is None else success & (rows >= low)
            success = success if high is None else success & (rows <= high)
            bad, missing, base = F.lit(0).cast("long"), F.lit(0).cast("long"), rows
        else:
            bad = F.col(f"bad{i}")
            missing = rows - F.col(f"known{i}")
            base = rows if rule.counts_nulls else F.col(f"known{i}")
            good_share = (base - bad) / F.nullif(base, F.lit(0))
            success = F.coalesce(good_share >= rule.mostly, F.lit(True))
        results.append(
            F.struct(
                F.lit(i).alias("rule_number"),
                F.lit(rule.name).alias("rule"),
                F.lit(rule.column or "TABLE").alias("column"),
                F.lit(json.dumps(rule.kwargs, ensure_ascii=False)).alias("kwargs"),
                rows.alias("element_count"),
                missing.alias("missing_count"),
                bad.alias("unexpected_count"),
                F.round(bad * 100.0 / F.nullif(base, F.lit(0)), 4).cast("double").alias("unexpected_percent"),
                success.alias("success"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*results)))


def unexpected_sample(df: DataFrame, rule: Rule, size: int = SAMPLE_SIZE) -> DataFrame:
    """Some of the values that break a rule."""
    return df.filter(rule.unexpected()).select(rule.col.cast("string").alias("value")).limit(size)


def unexpected_values(df: DataFrame, rule: Rule) -> DataFrame:
    """All distinct values that break a rule, with their counts."""
    broken = df.filter(rule.unexpected()).groupBy(rule.col.cast("string").alias("value"))
    return broken.agg(F.count("*").alias("rows")).select(
        F.lit(rule.name).alias("rule"), F.lit(rule.column).alias("column"), "value", "rows"
    )


def failures(df: DataFrame, rules: Sequence[Rule]) -> list[dict]:
    """Failed rules with what was observed, including sample values."""
    failed = evaluate(df, rules).filter(~F.col("success")).collect()
    found = []
    for row in failed:
        rule = rules[row["rule_number"]]
        sample = [] if rule.column is None else [r["value"] for r in unexpected_sample(df, rule).collect()]
        found.append({**row.asDict(), "sample": sample})
    return found


def gate(df: DataFrame, rules: Sequence[Rule], history: str | None = None, run_id: str | None = None) -> DataFrame:
    """Pass ``df`` through if all rules hold, else raise with the list of failures.

    Reads ``df`` once, and again only for samples of failed rules. With ``history``, results are appended there.
    """
    report = evaluate(df, rules)
    results = report.collect()
    if history is not None:
        store_results(df.sparkSession.createDataFrame(results, report.schema), history, run_id or "")
    failed = [r for r in results if not r["success"]]
    if not failed:
        return df
    lines = [f"{len(failed)} of {len(rules)} rules failed"]
    for row in failed:
        rule = rules[row["rule_number"]]
        sample = [] if rule.column is None else [r["value"] for r in unexpected_sample(df, rule).collect()]
        lines.append(
            f"{row['rule']} on {row['column']} {row['kwargs']}: {row['unexpected_count']} of "
            f"{row['element_count']} rows, sample {sample}"
        )
    raise QualityGateError("\n".join(lines))


def store_results(results: DataFrame, path: str, run_id: str) -> None:
    stamped = results.withColumn("run_id", F.lit(run_id)).withColumn("run_time", F.current_timestamp())
    stamped.coalesce(1).write.mode("append").parquet(path)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty for a valid natural key."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
