"""Cleaning and typing of cohort rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar import schema
from regiostar.functions.numbers import integer, numeric
from regiostar.functions.text import drop_thousands, standardise, strip
from regiostar.session import small_methods
from regiostar.sources.columns import require_columns, strip_column_names

YEAR_SOURCE = schema.PERIOD.fields[0].source
REGION_SOURCE = schema.GEOGRAPHY.fields[1].source
SECTOR_SOURCE = schema.PROGRAM.fields[0].source


def _quoted(name: str):
    return F.col(f"`{name}`")


def parse_year(df: DataFrame, column: str) -> DataFrame:
    """``"2,015"`` to 2015; text that is no whole number raises."""
    return df.withColumn(column, drop_thousands(_quoted(column).cast("string")).cast("int"))


def standardise_text(df: DataFrame) -> DataFrame:
    """Strip and upper-case every text column; nulls stay null."""
    return df.select(
        *[
            standardise(_quoted(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else _quoted(f.name)
            for f in df.schema.fields
        ]
    )


def clean_and_standardise(df: DataFrame, year: str = YEAR_SOURCE, sector: str = SECTOR_SOURCE) -> DataFrame:
    small_methods(df.sparkSession)
    df = strip_column_names(df).fillna({sector: schema.NO_SECTOR})
    return parse_year(standardise_text(df), year)


def clean_join_keys(df: DataFrame, year: str = YEAR_SOURCE, region: str = REGION_SOURCE) -> DataFrame:
    """Only the two join keys, on a raw frame."""
    df = strip_column_names(df)
    require_columns(df, [year, region], "cohort")
    return parse_year(df, year).withColumn(region, standardise(_quoted(region).cast("string")))


def map_columns(df: DataFrame, fields: Iterable[schema.Field], keep: Sequence[str] = ()) -> DataFrame:
    """Rename source columns and cast them: whole numbers or null, stripped text."""
    small_methods(df.sparkSession)
    fields = list(fields)
    require_columns(df, [f.source for f in fields], "source")
    mapped = [
        (integer(df, f.source) if f.type == "int" else strip(_quoted(f.source).cast("string"))).alias(f.name)
        for f in fields
    ]
    return df.select(*mapped, *[_quoted(name) for name in keep])


def drop_incomplete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def resolve_macro_columns(
    df: DataFrame, aliases: Mapping[str, Sequence[str]] = schema.MACRO_ALIASES
) -> tuple[DataFrame, list[str]]:
    """For each target the first alias present, as a 32-bit float; targets without one are null.

    Returns the frame and the targets that found no column.
    """
    present = set(df.columns)
    chosen = {target: next((a for a in names if a in present), None) for target, names in aliases.items()}
    used = {alias for alias in chosen.values() if alias}
    columns = [_quoted(c) for c in df.columns if c not in used and c not in aliases]
    for target, alias in chosen.items():
        value = F.lit(None) if alias is None else numeric(df, alias)
        columns.append(value.cast("float").alias(target))
    return df.select(*columns), [target for target, alias in chosen.items() if alias is None]


def in_target(df: DataFrame, stratum: str = schema.STRATUM, sector: str = schema.SECTOR) -> DataFrame:
    """Rows of the strata and sectors that the mart reports on."""
    return df.filter(F.col(stratum).isin(*schema.TARGET_STRATA) & F.col(sector).isin(*schema.TARGET_SECTORS))
