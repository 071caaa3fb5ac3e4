"""Star schema: dimensions with surrogate keys, and facts that refer to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiostar import schema
from regiostar.operators.numbering import SINGLE_TASK_ROWS, number_rows
from regiostar.session import materialize
from regiostar.sources.columns import require_columns

_SET = "_set"
_NUMBER = "_number"


def _set_number(names: Sequence[str], dimension: schema.Dimension) -> int:
    """grouping_id has a bit for each grouping column, 1 where the set leaves the column out."""
    return int("".join("0" if n in dimension.names else "1" for n in names), 2)


def grouped_members(cohort: DataFrame, dimensions: Sequence[schema.Dimension] = schema.DIMENSIONS) -> DataFrame:
    """Distinct natural keys of all dimensions from one scan, reduced in each task before the shuffle."""
    names = _member_names(dimensions)
    require_columns(cohort, names, "cohort")
    sets = [[F.col(n) for n in d.names] for d in dimensions]
    grouped = cohort.select(*names).groupingSets(sets, *[F.col(n) for n in names])
    return materialize(grouped.agg(F.grouping_id().alias(_SET)), "dimension-members")


def _member_names(dimensions: Sequence[schema.Dimension]) -> list[str]:
    return [n for d in dimensions for n in d.names]


def members_of(grouped: DataFrame, dimension: schema.Dimension) -> DataFrame:
    number = _set_number(_member_names(schema.DIMENSIONS), dimension)
    return grouped.filter(F.col(_SET) == number).select(*dimension.names)


def set_sizes(grouped: DataFrame) -> dict[str, int]:
    """Members per dimension, counted in one job."""
    sizes = {r[0]: r[1] for r in grouped.groupBy(_SET).count().collect()}
    names = _member_names(schema.DIMENSIONS)
    return {d.table: sizes.get(_set_number(names, d), 0) for d in schema.DIMENSIONS}


def number_all(
    grouped: DataFrame, after: Mapping[str, int], single_task_rows: int = SINGLE_TASK_ROWS
) -> dict[str, DataFrame]:
    """Members of all dimensions that have any, numbered after the given keys in natural key order.

    Small sets are numbered together, one task per dimension, and written once. Larger ones are numbered by parts.
    """
    sizes = set_sizes(grouped)
    names = _member_names(schema.DIMENSIONS)
    small = [d for d in schema.DIMENSIONS if 0 < sizes[d.table] <= single_task_rows]
    numbered = {
        d.table: number_rows(members_of(grouped, d), d.names, d.key, after[d.table], 0, sizes[d.table])
        for d in schema.DIMENSIONS
        if sizes[d.table] > single_task_rows
    }
    if small:
        sets = [_set_number(names, d) for d in small]
        number = F.row_number().over(W.partitionBy(_SET).orderBy(*names))
        together = materialize(grouped.filter(F.col(_SET).isin(sets)).select("*", number.alias(_NUMBER)), "numbered")
        for d in small:
            key = (F.col(_NUMBER) + F.lit(after[d.table])).cast("int").alias(d.key)
            numbered[d.table] = together.filter(F.col(_SET) == _set_number(names, d)).select(key, *d.names)
    return numbered


def new_dimensions(cohort: DataFrame, single_task_rows: int = SINGLE_TASK_ROWS) -> dict[str, DataFrame]:
    """Dimensions numbered 1..n in natural key order; null keys are members like any other."""
    return number_all(grouped_members(cohort), {d.table: 0 for d in schema.DIMENSIONS}, single_task_rows)


def absent_members(members: DataFrame, existing: DataFrame, dimension: schema.Dimension) -> DataFrame:
    """Members without nulls whose natural key the existing dimension does not hold."""
    known = existing.select(*dimension.names)
    return members.dropna(subset=dimension.names).join(known, dimension.names, "left_anti")


def largest_keys(existing: Mapping[str, DataFrame]) -> dict[str, int]:
    """Largest surrogate key per dimension, 0 for an empty one, in one job."""
    maxima = [
        existing[d.table].agg(F.lit(d.table).alias("table"), F.coalesce(F.max(d.key), F.lit(0)).alias("largest"))
        for d in schema.DIMENSIONS
    ]
    return {r["table"]: r["largest"] for r in reduce(DataFrame.unionByName, maxima).collect()}


def upsert_members(
    grouped: DataFrame, existing: Mapping[str, DataFrame], single_task_rows: int = SINGLE_TASK_ROWS
) -> dict[str, DataFrame]:
    """New members of each dimension that has any, numbered on from its largest key.

    Existing members keep their keys, so a second load of the same rows adds nothing.
    """
    names = _member_names(schema.DIMENSIONS)
    absent = []
    for d in schema.DIMENSIONS:
        rows = absent_members(members_of(grouped, d), existing[d.table], d)
        others = [F.lit(None).cast(grouped.schema[n].dataType).alias(n) for n in names if n not in d.names]
        absent.append(rows.select(*d.names, *others, F.lit(_set_number(names, d)).cast("long").alias(_SET)))
    fresh = materialize(reduce(DataFrame.unionByName, absent), "new-members")
    return number_all(fresh, largest_keys(existing), single_task_rows)


def lookup_keys(cohort: DataFrame, dimensions: Mapping[str, DataFrame], null_safe: bool) -> DataFrame:
    """Left-join the surrogate key of each dimension on its natural key.

    The dimensions come from written tables, so Catalyst broadcasts those below its size threshold and
    shuffles the others, where adaptive execution splits hot keys.
    """
    rows = cohort
    for d in schema.DIMENSIONS:
        renamed = dimensions[d.table].select(d.key, *[F.col(n).alias(f"_dim_{n}") for n in d.names])
        same = F.lit(True)
        for n in d.names:
            left, right = F.col(n), F.col(f"_dim_{n}")
            same = same & (F.equal_null(left, right) if null_safe else left == right)
        rows = rows.join(renamed, same, "left").drop(*[f"_dim_{n}" for n in d.names])
    return rows


def unresolved() -> Column:
    condition = F.lit(False)
    for key in schema.SURROGATE_KEYS:
        condition = condition | F.col(key).isNull()
    return condition


def fact_rows(cohort: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Null-safe lookup: every cohort row becomes a fact row. The year stays for partitioning."""
    return lookup_keys(cohort, dimensions, null_safe=True).select(
        *schema.SURROGATE_KEYS, *[f.name for f in schema.FACT_FIELDS], schema.YEAR
    )


def resolved_fact(
    cohort: DataFrame, dimensions: Mapping[str, DataFrame], macro: Sequence[str] = (schema.MACRO_VALUE,)
) -> tuple[DataFrame, DataFrame]:
    """Fact rows with all four keys, and the rejected cohort rows. Both keep the year for partitioning."""
    keyed = lookup_keys(cohort, dimensions, null_safe=False)
    columns = [*schema.SURROGATE_KEYS, *[f.name for f in schema.FACT_FIELDS]]
    require_columns(keyed, [*columns, *macro], "fact")
    values = [F.col(m).cast(schema.MACRO_VALUE_TYPE).alias(m) for m in macro]
    accepted = keyed.filter(~unresolved()).select(*columns, *values, schema.YEAR)
    return accepted, keyed.filter(unresolved())


def star_join(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Inner join of the fact with its four dimensions.

    The year is the fact's own, which names its folders, so a filter on it prunes them.
    """
    rows = fact
    for d in schema.DIMENSIONS:
        rows = rows.join(dimensions[d.table].drop(schema.YEAR), d.key)
    return rows


def orphan_counts(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Per dimension, fact rows and distinct keys without a member. One scan counts the rows per key of all dimensions."""
    keys = schema.SURROGATE_KEYS
    counted = fact.groupingSets([[F.col(k)] for k in keys], *keys).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("rows")
    )
    used = materialize(counted, "used-keys")
    checks = []
    for i, d in enumerate(schema.DIMENSIONS):
        own = 2 ** len(keys) - 1 - 2 ** (len(keys) - 1 - i)  # all columns but this one are left out
        orphans = used.filter(F.col("_set") == own).join(dimensions[d.table], d.key, "left_anti")
        checks.append(
            orphans.agg(
                F.lit(d.table).alias("dimension"),
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
            )
        )
    return reduce(DataFrame.unionByName, checks)
