"""Cohort and macro rows derived from the sales tables of a test-data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostar import schema

# Region code, canonical name and the differently spelled name of the macro records.
REGION_NAMES = (
    (0, "ANTIOQUIA", "antioquia"), (1, "ATLÁNTICO", "Atlantico "), (2, "BOGOTÁ D.C.", "BOGOTA, D.C."),
    (3, "BOLÍVAR", "BOLIVAR"), (4, "BOYACÁ", "BOYACA"), (5, "CALDAS", "CALDAS"), (6, "CAQUETÁ", "CAQUETA"),
    (7, "CAUCA", "CAUCA"), (8, "CESAR", "CESAR"), (9, "CÓRDOBA", "CORDOBA"),
    (10, "CUNDINAMARCA", "CUNDINAMARCA"), (11, "CHOCÓ", "CHOCO"), (12, "HUILA", "HUILA"),
    (13, "LA GUAJIRA", "GUAJIRA"), (14, "MAGDALENA", "MAGDALENA"), (15, "META", "META"),
    (16, "NARIÑO", "narino"), (17, "NORTE DE SANTANDER", "NORTE SANTANDER"), (18, "QUINDÍO", "QUINDIO"),
    (19, "RISARALDA", "RISARALDA"), (20, "SANTANDER", "SANTANDER"), (21, "SUCRE", "SUCRE"),
    (22, "TOLIMA", "TOLIMA"), (23, "VALLE DEL CAUCA", "VALLE"), (24, "ARAUCA", "ARAUCA"),
)
# The sales years are 1995 to 2001, so the macro records start in 1998 rather than 2018.
MACRO_MIN_YEAR = 1998


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores if the files give fewer tasks than that; large tables stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def region_names(spark: SparkSession) -> DataFrame:
    """The list above; its 25 rows may always be broadcast."""
    return F.broadcast(spark.createDataFrame(list(REGION_NAMES), "code int, canonical string, dirty string"))


def cohort(spark: SparkSession, folder: str) -> DataFrame:
    """Cohort rows, one per line item, under the table names."""
    price = F.col("l_extendedprice")
    return (
        spread(table(spark, folder, "lineitem"), "l_orderkey")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(region_names(spark), F.col("c_nationkey") == F.col("code"))
        .select(
            F.year("o_orderdate").alias("vigencia"),
            F.when(F.month("o_orderdate") <= 6, "S1").otherwise("S2").alias("periodo_otorgamiento"),
            F.col("c_nationkey").alias("codigo_departamento"),
            F.col("canonical").alias("departamento"),
            F.col("r_name").alias("categoria_municipio"),
            F.when(F.col("l_returnflag") == "A", "OFICIAL")
            .when(F.col("l_returnflag") == "N", "PRIVADO")
            .alias("sector_ies"),
            F.col("o_orderpriority").alias("nivel_formacion"),
            F.col("l_linestatus").alias("modalidad_linea"),
            F.col("o_orderstatus").alias("modalidad_credito"),
            F.col("c_mktsegment").alias("sexo_al_nacer"),
            F.col("l_linenumber").alias("estrato_socioeconomico"),
            F.when(price < 20000, "BAJO").when(price < 60000, "MEDIO").otherwise("ALTO")
            .alias("rango_valor_desembolsado"),
            F.col("l_quantity").cast("int").alias("total_nuevos_beneficiarios"),
        )
    )


def macro_records(spark: SparkSession, folder: str) -> DataFrame:
    """Macro records as text, one per order."""
    return (
        spread(table(spark, folder, "orders"), "o_orderkey")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(region_names(spark), F.col("c_nationkey") == F.col("code"))
        .select(
            F.year("o_orderdate").cast("string").alias("a_o"),
            F.col("dirty").alias("departamento"),
            F.col("o_orderpriority").alias("actividad"),
            F.when(F.col("o_orderstatus") == "F", "Primario")
            .when(F.col("o_orderstatus") == "O", "Secundario")
            .otherwise("Terciario")
            .alias("sector"),
            F.when(F.col("o_orderkey") % 2 == 0, "Corrientes").otherwise("Constantes").alias("tipo_de_precios"),
            F.col("code").cast("string").alias("c_digo_departamento_divipola"),
            F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("valor_miles_de_millones_de"),
        )
    )


def recent_macro(spark: SparkSession, folder: str) -> DataFrame:
    return macro_records(spark, folder).filter(F.col("a_o") >= F.lit(str(MACRO_MIN_YEAR)))


def cleaned(cohort_rows: DataFrame) -> DataFrame:
    return cohort_rows.fillna({schema.SECTOR: schema.NO_SECTOR})


def delivered(cohort_rows: DataFrame) -> DataFrame:
    """Cohort rows as a cohort file holds them: source headers, thousands separators, padding, lower case."""
    columns = []
    for f in schema.COHORT_FIELDS:
        col = F.col(f.name)
        if f.name in (schema.YEAR, schema.MEASURE):
            col = F.format_number(col, 0)
        elif f.type == "string":
            shift = F.col(schema.STRATUM) % 3
            col = F.when(shift == 0, col).when(shift == 1, F.lower(col)).otherwise(F.concat(F.lit("\u00a0 "), col, F.lit("\t")))
        columns.append(col.cast("string").alias(f.source))
    return cohort_rows.select(*columns)
