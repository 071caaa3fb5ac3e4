"""Report queries over the mart."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiostar import schema
from regiostar.functions.numbers import percent
from regiostar.plans.mart import MACRO_MEAN, TOTAL


def yearly_evolution(mart: DataFrame) -> DataFrame:
    """Beneficiaries and mean regional GDP by year."""
    return mart.groupBy(schema.YEAR).agg(
        F.sum(TOTAL).alias(TOTAL), F.round(F.avg(MACRO_MEAN), 4).alias("pib_promedio")
    )


def sector_shares(mart: DataFrame, by: Sequence[str] = (schema.YEAR,)) -> DataFrame:
    """Share of each sector within ``by``; the window sees one row per sector."""
    totals = mart.groupBy(*by, schema.SECTOR).agg(F.sum(TOTAL).alias(TOTAL))
    return totals.withColumn("cuota_pct", percent(F.col(TOTAL), F.sum(TOTAL).over(W.partitionBy(*by))))


def density_points(mart: DataFrame) -> DataFrame:
    """GDP against beneficiaries, for rows that have a GDP."""
    return mart.filter(F.col(MACRO_MEAN).isNotNull()).select(
        schema.YEAR, schema.REGION, schema.SECTOR, MACRO_MEAN, TOTAL, "densidad_credito_pib"
    )


def mart_slice(
    mart: DataFrame,
    years: Iterable[int] | None = None,
    regions: Iterable[str] | None = None,
    sectors: Iterable[str] | None = None,
    min_change: float | None = None,
    max_change: float | None = None,
) -> DataFrame:
    """Any combination of the report's slicers."""
    for column, values in ((schema.YEAR, years), (schema.REGION, regions), (schema.SECTOR, sectors)):
        if values is not None:
            mart = mart.filter(F.col(column).isin(*values))
    if min_change is not None:
        mart = mart.filter(F.col("variacion_yoy_pct") >= min_change)
    if max_change is not None:
        mart = mart.filter(F.col("variacion_yoy_pct") <= max_change)
    return mart
