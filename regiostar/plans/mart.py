"""The year × region × sector mart with changes, shares and ranks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiostar import schema
from regiostar.functions.numbers import percent, ratio
from regiostar.operators.clean import in_target
from regiostar.operators.star import star_join

GRAIN = [schema.YEAR, schema.REGION, schema.SECTOR]
CODE = "codigo_departamento"
TOTAL = "total_beneficiarios"
MACRO_MEAN = "pib_miles_millones_promedio"

MART_COLUMNS = [
    schema.YEAR,
    schema.REGION,
    CODE,
    schema.SECTOR,
    TOTAL,
    "num_registros_fact",
    MACRO_MEAN,
    "participacion_sector_pct",
    "beneficiarios_anio_anterior",
    "variacion_yoy_pct",
    "variacion_yoy_pib_pct",
    "densidad_credito_pib",
    "participacion_anterior_pct",
    "variacion_cuota_pp",
    "rank_depto_por_sector",
]


def mart_base(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Sum, count and mean per year, region, code and sector, for the target strata and sectors.

    The filters reach the dimensions, and each task reduces its fact rows before the only shuffle. The
    windows below therefore never see a fact row, only these totals.
    """
    return (
        in_target(star_join(fact, dimensions))
        .groupBy(schema.YEAR, schema.REGION, CODE, schema.SECTOR)
        .agg(
            F.sum(schema.MEASURE).alias(TOTAL),
            F.count("*").alias("num_registros_fact"),
            F.avg(schema.MACRO_VALUE).cast("decimal(19,8)").alias(MACRO_MEAN),
        )
    )


def _whole(value: Column) -> Column:
    """The mean's eight decimals as a whole number, so that ratios stay exact."""
    return (value * F.lit(10**8).cast("decimal(9,0)")).cast("decimal(24,0)")


def previous(column: str | Column) -> Column:
    """Value of the previous year present in the series, which need not be the year before."""
    return F.lag(column).over(W.partitionBy(schema.REGION, schema.SECTOR).orderBy(schema.YEAR))


def with_region_total(base: DataFrame) -> DataFrame:
    return base.withColumn("total_depto_anio", F.sum(TOTAL).over(W.partitionBy(schema.YEAR, schema.REGION)))


def with_share(base: DataFrame) -> DataFrame:
    return base.withColumn("participacion_sector_pct", percent(F.col(TOTAL), F.col("total_depto_anio")))


def with_yearly_change(base: DataFrame) -> DataFrame:
    before, mean = previous(TOTAL), F.col(MACRO_MEAN)
    # Scaling both sides keeps 14 decimals; totals too large for that are divided as they are, with 10 decimals.
    scaled = ratio(F.col(TOTAL) * F.lit(10**8).cast("decimal(9,0)"), _whole(mean), 4)
    direct = F.try_divide(F.col(TOTAL).cast("decimal(20,0)"), F.nullif(mean, F.lit(0)))
    return base.withColumns(
        {
            "beneficiarios_anio_anterior": before,
            "variacion_yoy_pct": percent(F.col(TOTAL) - before, before),
            "variacion_yoy_pib_pct": percent(_whole(mean) - _whole(previous(mean)), _whole(previous(mean))),
            "densidad_credito_pib": F.when(F.abs(TOTAL) < 10**15, scaled).otherwise(F.round(direct, 4).cast("decimal(29,4)")),
        }
    )


def with_share_change(base: DataFrame) -> DataFrame:
    """Previous rounded share, and the change of the unrounded shares, rounded last.

    Each share is divided first, with 19 decimals, so totals of any size fit. Rounding to 12 decimals before the last
    rounding removes what the divisions left over, which keeps halves halves.
    """
    share = F.try_divide(F.col(TOTAL).cast("decimal(19,0)"), F.nullif(F.col("total_depto_anio"), F.lit(0)).cast("decimal(19,0)"))
    change = F.round(F.round((share - previous(share)) * 100, 12), 2)
    return base.withColumns(
        {"participacion_anterior_pct": previous("participacion_sector_pct"), "variacion_cuota_pp": change}
    )


def with_rank(base: DataFrame) -> DataFrame:
    by_volume = W.partitionBy(schema.YEAR, schema.SECTOR).orderBy(F.desc(TOTAL))
    return base.withColumn("rank_depto_por_sector", F.rank().over(by_volume))


def mart_from_base(base: DataFrame) -> DataFrame:
    """Totals without a year or region have no regional total to be compared with, so they are left out."""
    complete = base.dropna(subset=[schema.YEAR, schema.REGION])
    enriched = with_rank(with_share_change(with_yearly_change(with_share(with_region_total(complete)))))
    rounded = enriched.withColumn(MACRO_MEAN, F.round(MACRO_MEAN, 4))
    return rounded.select(*MART_COLUMNS)


def credit_mart(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    return mart_from_base(mart_base(fact, dimensions)).orderBy(*GRAIN)
