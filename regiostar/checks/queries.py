"""One query per operator, each over whole tables of a test-data folder.

Results carry plain types only: decimals become doubles, so that any SQL engine can be compared.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar import fixtures as fx
from regiostar import schema
from regiostar.functions.text import strip_accents
from regiostar.operators import clean, fuzzy, merge, profile, quality, star, typing
from regiostar.operators.quantiles import exact_quantiles
from regiostar.plans import dashboard, mart
from regiostar.plans.runs import RunConfig, run_full_refresh, run_incremental
from regiostar.plans.warehouse import RESULTS_TABLE, Warehouse
from regiostar.session import fresh_path, materialize, small_methods
from regiostar.sources import cohort_csv, macro_records, staging
from regiostar.sources.columns import column_report
from regiostar.streaming.batches import load_batches
from regiostar.streaming.monthly import MonthlyRuns

Query = Callable[[SparkSession, str], DataFrame]

VALUE = schema.MACRO_ALIASES[schema.MACRO_VALUE][0]


def plain(df: DataFrame) -> DataFrame:
    kinds = (T.DecimalType, T.FloatType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, kinds) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# Inputs


def _cohort(spark: SparkSession, folder: str) -> DataFrame:
    return fx.cleaned(fx.cohort(spark, folder))


def _staged(spark: SparkSession, folder: str) -> DataFrame:
    """The cohort as a staging table, for flows that read it more than once."""
    return materialize(_cohort(spark, folder), "cohort")


def _macro(spark: SparkSession, folder: str) -> DataFrame:
    return typing.optimise_types(materialize(fx.recent_macro(spark, folder), "macro"))


def _merge(spark: SparkSession, folder: str) -> merge.MacroMerge:
    return merge.merge_macro(_staged(spark, folder), _macro(spark, folder), values=[VALUE])


def _merged_rows(spark: SparkSession, folder: str) -> DataFrame:
    return clean.resolve_macro_columns(_merge(spark, folder).rows)[0]


def _star(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    rows = _merged_rows(spark, folder)
    dimensions = star.new_dimensions(rows)
    return star.resolved_fact(rows, dimensions)[0], dimensions


def _base(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per year, region and sector straight from the cohort, without macro values."""
    keys = [schema.YEAR, schema.REGION, mart.CODE, schema.SECTOR]
    return clean.in_target(fx.cohort(spark, folder)).groupBy(*keys).agg(F.sum(schema.MEASURE).alias(mart.TOTAL))


def _delivered_csv(spark: SparkSession, folder: str, delimiter: str) -> str:
    path = fresh_path(spark, "delivered-csv")
    writer = fx.delivered(fx.cohort(spark, folder)).write.option("header", True).option("sep", delimiter)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("escape", '"').csv(path)
    return path


def _delivered_json(spark: SparkSession, folder: str) -> str:
    path = fresh_path(spark, "delivered-json")
    fx.macro_records(spark, folder).write.json(path)
    return path


# Sources and sinks


def csv_extract(spark: SparkSession, folder: str, delimiter: str | None = ",") -> DataFrame:
    written = delimiter or ";"
    df = cohort_csv.extract_csv(spark, _delivered_csv(spark, folder, written), delimiter)
    return df.groupBy(
        F.col("VIGENCIA").alias("vigencia_text"), F.coalesce(F.col("`SECTOR IES`"), F.lit("-")).alias("sector_text")
    ).agg(
        F.count("*").alias("n_rows"),
        F.sum("`NÚMERO DE NUEVOS BENEFICIARIOS DE CRÉDITO`").alias("beneficiaries"),
        F.sum("`CÓDIGO DEDEPARTAMENTO DE ORIGEN`").alias("codes"),
        F.count("`ESTRATO SOCIOECONÓMICO`").alias("strata"),
    )


def required_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Which columns of a delivery that renamed one and lost one are there, and how many values they hold."""
    delivered = fx.table(spark, folder, "lineitem").withColumnRenamed("l_discount", "l_rebate").drop("l_tax")
    return column_report(delivered, ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_rebate"])


def csv_sniffed(spark: SparkSession, folder: str) -> DataFrame:
    return csv_extract(spark, folder, delimiter=None)


def macro_extract(spark: SparkSession, folder: str) -> DataFrame:
    df = macro_records.extract_records(spark, _delivered_json(spark, folder), min_year=fx.MACRO_MIN_YEAR)
    return plain(
        df.groupBy("a_o", "departamento").agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("actividad").alias("activities"),
            F.sum(F.col(VALUE).cast("decimal(15,2)")).alias("total"),
        )
    )


def macro_pages(spark: SparkSession, folder: str) -> DataFrame:
    records = macro_records.read_records(spark, _delivered_json(spark, folder), min_year=None)
    return records.select(
        F.lit("records").alias("what"), macro_records.PAGE
    ).groupBy("what").agg(F.count("*").alias("records"), F.min(F.length(macro_records.PAGE) > 0).alias("named"))


PAGES_PER_WRITE = 200  # page files one task writes


def _land_pages(records: DataFrame, path: str) -> None:
    """A file per ``page`` with its records as JSON lines.

    Writing costs a file per page, not bytes: a fixed number of pages per task, so that adaptive execution does not
    coalesce thousands of pages into the few tasks their bytes would fill. On a local or mounted folder Spark's writer
    starts two processes per file to set its mode, and a folder per page is listed by a task of its own. There, tasks
    write the files themselves, a folder per task; a file gets its name when it is whole.
    """
    tasks = max(-(-records.select("page").distinct().count() // PAGES_PER_WRITE), 1)
    dealt = records.repartition(tasks, "page")
    context = records.sparkSession.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    landing = str(target.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(target))
    if not landing.startswith("file:"):
        dealt.write.partitionBy("page").json(path)
        return
    folder = "/" + landing.removeprefix("file:").lstrip("/")
    os.makedirs(folder, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        own, attempt = f"{folder}/task={context.partitionId()}", f".{context.taskAttemptId()}.json"
        os.makedirs(own, exist_ok=True)
        page, file = None, None

        def close() -> None:
            if file is not None:
                file.close()
                os.replace(f"{own}/{attempt}", f"{own}/part-{context.partitionId():05d}-page={page}.json")

        for batch in batches:
            numbers, lines = batch.column("page"), batch.column("line")
            starts = [0, *(np.flatnonzero(np.diff(numbers.to_numpy())) + 1).tolist(), len(batch)]
            for start, end in zip(starts, starts[1:]):
                if end > start:
                    if (number := numbers[start].as_py()) != page:
                        close()
                        page, file = number, open(f"{own}/{attempt}", "w", encoding="utf-8")
                    file.write("\n".join([*lines.slice(start, end - start).to_pylist(), ""]))
        close()
        yield from ()

    line = F.to_json(F.struct(*[c for c in records.columns if c != "page"])).alias("line")
    written = dealt.sortWithinPartitions("page").select("page", line).mapInArrow(write, "page long")
    written.write.format("noop").mode("overwrite").save()


def page_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as pages of 100 keys: every eleventh page is missing, every seventh lacks its later keys."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    page = F.floor(F.col("o_orderkey") / 100)
    landed = orders.filter((page % 11 != 3) & ((page % 7 != 2) | (F.col("o_orderkey") % 100 < 60)))
    path = fresh_path(spark, "landed-pages")
    _land_pages(landed.select(F.col("o_orderkey").cast("string").alias("key"), page.alias("page")), path)
    pattern = r"page=(\d+)[./]"
    found = macro_records.read_records(spark, path, min_year=None, columns=("key",), page_number=pattern)
    return macro_records.page_report(found, 100, macro_records.landed_pages(spark, path, pattern))


def malformed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders delivered as CSV and JSON lines, some with a surplus field, an open quote, a missing field or a cut-off end."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    end = F.when(key % 7 == 0, ',x').when(key % 5 == 0, ',"x, y",extra').when(key % 3 == 0, "").otherwise(',"x, y"')
    lines, texts = fresh_path(spark, "lines"), fresh_path(spark, "records")
    orders.select(F.concat(key.cast("string"), F.when(key % 7 == 0, ',"').otherwise(","), status, end)).write.text(lines)
    record = F.to_json(F.struct(key.cast("string").alias("key"), status.alias("status")))
    orders.select(F.when(key % 4 == 0, F.substring(record, 1, 12)).otherwise(record)).write.text(texts)
    rows = materialize(cohort_csv.read_csv_rows(spark, lines, names=["key", "status", "note"]), "csv-rows")
    records = materialize(macro_records.read_record_rows(spark, texts, ("key", "status")), "json-rows")
    whole = F.sum(F.col("key").cast("long")).alias("keys")
    return (
        cohort_csv.rejected(rows).groupBy(F.lit("csv").alias("format"), F.col(cohort_csv.REASON).alias("outcome")).agg(F.count("*").alias("n_rows"), F.lit(None).cast("long").alias("keys"))
        .union(cohort_csv.kept(rows).groupBy(F.lit("csv"), F.when(F.col("note").isNull(), "short").otherwise("kept")).agg(F.count("*"), whole))
        .union(macro_records.rejected(records).groupBy(F.lit("json"), F.lit("rejected")).agg(F.count("*"), F.lit(None).cast("long")))
        .union(macro_records.kept(records).groupBy(F.lit("json"), F.lit("kept")).agg(F.count("*"), whole))
    )


def parquet_staging(spark: SparkSession, folder: str) -> DataFrame:
    path = staging.write_staging(_cohort(spark, folder), fresh_path(spark, "staging"))
    return (
        staging.read_staging(spark, path)
        .groupBy(schema.YEAR, schema.REGION)
        .agg(F.count("*").alias("n_rows"), F.sum(schema.MEASURE).alias("beneficiaries"))
    )


# Cleaning


def cleaned_cohort(spark: SparkSession, folder: str) -> DataFrame:
    raw = fx.delivered(fx.cohort(spark, folder))
    padded = raw.toDF(*[f" {c} " for c in raw.columns])
    df = clean.clean_and_standardise(padded)
    names = ("SECTOR IES", "DEPARTAMENTO DE ORIGEN", "NIVEL DE FORMACIÓN", "SEXO AL NACER")
    return df.groupBy(
        F.col("VIGENCIA").alias("vigencia"), *[F.col(f"`{n}`").alias(a) for n, a in zip(names, ("sector", "region", "level", "sex"))]
    ).agg(F.count("*").alias("n_rows"))


def join_keys(spark: SparkSession, folder: str) -> DataFrame:
    df = clean.clean_join_keys(fx.delivered(fx.cohort(spark, folder)))
    return df.groupBy(F.col("VIGENCIA").alias("vigencia"), F.col("`DEPARTAMENTO DE ORIGEN`").alias("region")).agg(
        F.count("*").alias("n_rows")
    )


def accent_removal(spark: SparkSession, folder: str) -> DataFrame:
    return fx.table(spark, folder, "documents").select("doc_id", F.md5(strip_accents(F.col("text"))).alias("plain_md5"))


def typed_columns(spark: SparkSession, folder: str) -> DataFrame:
    stratum = F.col(schema.STRATUM).cast("string")
    raw = fx.cohort(spark, folder).select(
        *[
            (
                F.when(F.col(schema.STRATUM) == 7, "x7").otherwise(F.concat(stratum, F.lit(".0")))
                if f.name == schema.STRATUM
                else F.concat(F.lit(" "), F.col(f.name).cast("string"))
            ).alias(f.source)
            for f in schema.COHORT_FIELDS
        ]
    )
    df = clean.map_columns(raw, schema.COHORT_FIELDS)
    return df.groupBy(schema.YEAR, schema.REGION).agg(
        F.count("*").alias("n_rows"),
        F.count(schema.STRATUM).alias("known_strata"),
        F.sum(schema.STRATUM).alias("strata_sum"),
        F.sum(schema.MEASURE).alias("beneficiaries"),
    )


def macro_aliases(spark: SparkSession, folder: str) -> DataFrame:
    macro = fx.recent_macro(spark, folder)
    aliases = {"pib": ("no_such_column", VALUE, "a_o"), "ipc": ("no_such_column",)}
    df, _ = clean.resolve_macro_columns(macro, aliases)
    return df.groupBy("a_o").agg(F.count("pib").alias("pib_values"), F.count("ipc").alias("ipc_values"), F.max("pib").cast("double").alias("largest"))


def inferred_types(spark: SparkSession, folder: str) -> DataFrame:
    events = fx.table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("fecha"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.when(F.col("event_id") % 20 == 0, "n/d").otherwise(F.col("value").cast("string")).alias("value"),
        "props",
    )
    return typing.inferred_types(events)


def complete_rows(spark: SparkSession, folder: str) -> DataFrame:
    macro = fx.table(spark, folder, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, "s/f")
        .otherwise(F.concat(F.year("o_orderdate").cast("string"), F.lit(".0")))
        .alias("a_o")
    )
    return merge.with_macro_year(macro).groupBy("a_o").agg(F.count("*").alias("n_rows"))


def target_rows(spark: SparkSession, folder: str) -> DataFrame:
    return clean.in_target(fx.cohort(spark, folder)).groupBy(schema.SECTOR, schema.STRATUM).agg(
        F.count("*").alias("n_rows"), F.sum(schema.MEASURE).alias("beneficiaries")
    )


def comma_audit(spark: SparkSession, folder: str) -> DataFrame:
    years = profile.comma_count(fx.delivered(fx.cohort(spark, folder)), "VIGENCIA")
    texts = profile.comma_count(fx.table(spark, folder, "documents"), "text")
    return years.select(F.lit("vigencia").alias("source"), "*").unionByName(
        texts.select(F.lit("documents").alias("source"), "*")
    )


# Names and macro values


def fuzzy_mapping(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy.map_names(
        fx.recent_macro(spark, folder), "departamento", fx.cohort(spark, folder), schema.REGION
    )


def mapped_names(spark: SparkSession, folder: str) -> DataFrame:
    macro = fx.recent_macro(spark, folder)
    mapping = materialize(fuzzy_mapping(spark, folder), "name-mapping")
    return (
        fuzzy.apply_mapping(macro, "departamento", mapping, "canonical")
        .groupBy(F.coalesce("canonical", F.lit("-")).alias("canonical"))
        .agg(F.count("*").alias("n_rows"))
    )


def name_scores(spark: SparkSession, folder: str) -> DataFrame:
    parts = fx.table(spark, folder, "part").select(
        F.col("p_name").alias("left"), F.concat_ws(" ", "p_type", "p_name", "p_brand").alias("right")
    )
    return fuzzy.with_name_score(parts.distinct(), "left", "right", "score")


def part_name_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Part names that lack their third letter, against type and name in the other order."""
    part = fx.table(spark, folder, "part")
    short = F.concat(F.substring("p_name", 1, 2), F.substring("p_name", 4, 100))
    sources = part.select(F.concat_ws(" ", short, F.lower("p_type")).alias("name"))
    targets = part.select(F.concat_ws(" ", "p_type", F.upper("p_name")).alias("name"))
    return fuzzy.map_names(sources, "name", targets, "name")


def macro_annual(spark: SparkSession, folder: str) -> DataFrame:
    _, annual, _ = merge.annual_macro(_macro(spark, folder), fx.cohort(spark, folder), schema.REGION)
    return plain(annual).withColumnsRenamed({"c_digo_departamento_divipola": "code_mean", VALUE: "value_mean"})


def merged_macro(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        _merged_rows(spark, folder)
        .groupBy(schema.YEAR, schema.REGION, schema.MACRO_VALUE)
        .agg(F.count("*").alias("n_rows"), F.sum(schema.MEASURE).alias("beneficiaries"))
    )


def unmatched_audit(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_merge(spark, folder).unmatched())


def unmatched_regions(spark: SparkSession, folder: str) -> DataFrame:
    return _merge(spark, folder).top_unmatched()


def residual_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return _merge(spark, folder).residual_nulls()


def macro_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_merge(spark, folder).coverage(VALUE))


def year_medians(spark: SparkSession, folder: str) -> DataFrame:
    quantiles = exact_quantiles(
        fx.macro_records(spark, folder).select("a_o", F.col(VALUE).cast("double").alias("value")), ["a_o"], "value", [0.5]
    )
    return quantiles.select("a_o", F.col("quantiles")[0].alias("median"))


# Star schema


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """All four dimensions in one listing: table, key and natural key as text."""
    return _listed(star.new_dimensions(_cohort(spark, folder)))


def _listed(dimensions: dict[str, DataFrame]) -> DataFrame:
    result = None
    for d in schema.DIMENSIONS:
        natural = F.concat_ws("|", *[F.col(n).cast("string") for n in d.names])
        rows = dimensions[d.table].select(F.lit(d.table).alias("dimension"), F.col(d.key).alias("sk"), natural.alias("natural_key"))
        result = rows if result is None else result.unionByName(rows)
    return result


def null_safe_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Null sectors stay null here, and must find their null member."""
    rows = materialize(fx.cohort(spark, folder), "cohort")
    fact = star.fact_rows(rows, star.new_dimensions(rows))
    return fact.groupBy(*schema.SURROGATE_KEYS).agg(
        F.count("*").alias("n_rows"), F.sum(schema.MEASURE).alias("beneficiaries")
    )


def resolved_fact(spark: SparkSession, folder: str) -> DataFrame:
    fact, _ = _star(spark, folder)
    grouped = fact.groupBy(*schema.SURROGATE_KEYS, "rango_valor_desembolsado")
    return plain(
        grouped.agg(
            F.count("*").alias("n_rows"),
            F.sum(schema.MEASURE).alias("beneficiaries"),
            F.max(schema.MACRO_VALUE).alias("gdp"),
        )
    )


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of later years find no period among the members of the years before 2000."""
    rows = _staged(spark, folder).withColumn(schema.MACRO_VALUE, F.lit(None).cast(schema.MACRO_VALUE_TYPE))
    dimensions = star.new_dimensions(rows.filter(F.col(schema.YEAR) < 2000))
    _, rejected = star.resolved_fact(rows, dimensions)
    return rejected.groupBy(schema.YEAR).agg(F.count("*").alias("n_rows"), F.count("sk_geography").alias("known_places"))


def star_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = _staged(spark, folder)
    dimensions = star.new_dimensions(rows)
    joined = star.star_join(star.fact_rows(rows, dimensions), dimensions)
    return joined.groupBy(schema.YEAR, schema.REGION, schema.SECTOR, schema.STRATUM).agg(
        F.count("*").alias("n_rows"), F.sum(schema.MEASURE).alias("beneficiaries")
    )


def orphan_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Facts against dimensions that lack the years from 2000 on."""
    rows = _staged(spark, folder)
    dimensions = star.new_dimensions(rows)
    known = dict(dimensions)
    known[schema.PERIOD.table] = dimensions[schema.PERIOD.table].filter(F.col(schema.YEAR) < 2000)
    return star.orphan_counts(star.fact_rows(rows, dimensions), known)


# Loads


def _with_macro(rows: DataFrame) -> DataFrame:
    """A macro value per row that any engine can compute: region code plus a quarter."""
    return rows.withColumn(schema.MACRO_VALUE, (F.col(mart.CODE) + F.lit(0.25)).cast(schema.MACRO_VALUE_TYPE))


def _fact_by_year(warehouse: Warehouse) -> DataFrame:
    return plain(
        warehouse.fact()
        .groupBy(schema.YEAR)
        .agg(
            F.count("*").alias("n_rows"),
            F.sum(schema.MEASURE).alias("beneficiaries"),
            F.sum(schema.MACRO_VALUE).alias("gdp"),
        )
    )


def member_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Members of the years before 1998 first, then all: the first keep their keys."""
    rows = _with_macro(_staged(spark, folder))
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    warehouse.load(rows.filter(F.col(schema.YEAR) < 1998))
    warehouse.load(rows)
    return _listed(warehouse.dimensions())


def year_replacement(spark: SparkSession, folder: str) -> DataFrame:
    """A second batch doubles 1999, brings 2001 without any valid row, and leaves the other years alone."""
    rows = _with_macro(_staged(spark, folder))
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    warehouse.load(rows)
    again = rows.filter(F.col(schema.YEAR).isin(1999, 2001))
    measure = F.col(schema.MEASURE)
    warehouse.load(
        again.withColumn(schema.MEASURE, F.when(F.col(schema.YEAR) == 1999, measure * 2).otherwise(measure)).withColumn(
            schema.STRATUM, F.when(F.col(schema.YEAR) == 1999, F.col(schema.STRATUM))
        )
    )
    return _fact_by_year(warehouse)


def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """First-generation run from a delivered CSV file, twice: the second replaces the first."""
    config = RunConfig(_delivered_csv(spark, folder, ","), fresh_path(spark, "warehouse"))
    run_full_refresh(spark, config)
    warehouse = run_full_refresh(spark, config)
    dimensions = warehouse.dimensions()
    joined = star.star_join(warehouse.fact(), dimensions)
    return joined.groupBy(schema.YEAR, schema.REGION, schema.SECTOR).agg(
        F.count("*").alias("n_rows"), F.sum(schema.MEASURE).alias("beneficiaries"), F.count(schema.MACRO_VALUE).alias("gdp_values")
    )


def _incremental(spark: SparkSession, folder: str):
    config = RunConfig(
        cohort_path=_delivered_csv(spark, folder, ","),
        macro_path=_delivered_json(spark, folder),
        warehouse_root=fresh_path(spark, "warehouse"),
        min_year=fx.MACRO_MIN_YEAR,
        rules=[
            quality.not_null(schema.YEAR),
            quality.not_null(mart.CODE),
            quality.in_set(schema.SECTOR, schema.ALLOWED_SECTORS),
            quality.in_set(schema.STRATUM, schema.ALLOWED_STRATA, mostly=0.80),
            quality.between(schema.MEASURE, low=0),
            quality.row_count_between(1, None),
        ],
    )
    return run_incremental(spark, config)[0]


def incremental_run(spark: SparkSession, folder: str) -> DataFrame:
    """Second-generation run from delivered CSV and JSON files to the refreshed mart."""
    return plain(_incremental(spark, folder).mart())


def mart_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Mart after the year 1999 was replaced by doubled measures."""
    rows = _with_macro(_staged(spark, folder))
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    warehouse.load(rows)
    warehouse.refresh_mart()
    doubled = rows.filter(F.col(schema.YEAR) == 1999).withColumn(schema.MEASURE, F.col(schema.MEASURE) * 2)
    warehouse.load(doubled)
    return plain(warehouse.refresh_mart())


def monthly_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Three landed batches: all years; then 1997 and 1998 again with doubled measures; then 1998 with tripled."""
    landing, root = fresh_path(spark, "landing"), fresh_path(spark, "warehouse")
    rows = _with_macro(_staged(spark, folder))
    year, measure = F.col(schema.YEAR), F.col(schema.MEASURE)
    warehouse, checkpoint = Warehouse(spark, root), f"{root}/_checkpoint"

    def land(batch: str, part: DataFrame) -> None:
        part.write.parquet(f"{landing}/batch={batch}")

    land("2024-01", rows)
    load_batches(spark, landing, warehouse, checkpoint)
    land("2024-02", rows.filter(year.isin(1997, 1998)).withColumn(schema.MEASURE, measure * 2))
    land("2024-03", rows.filter(year == 1998).withColumn(schema.MEASURE, measure * 3))
    load_batches(spark, landing, warehouse, checkpoint)
    return _fact_by_year(warehouse)


def failed_load(spark: SparkSession, folder: str) -> DataFrame:
    """A load that fails before it is published, over doubled measures and new members, changes nothing."""
    rows = _with_macro(_staged(spark, folder))
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    warehouse.load(rows.filter(F.col(schema.YEAR) < 2000))

    def fail() -> None:
        raise InterruptedError

    try:
        warehouse.load(rows.withColumn(schema.MEASURE, F.col(schema.MEASURE) * 2), before_publish=fail)
    except InterruptedError:
        pass
    members = warehouse.dimension(schema.PERIOD).agg(F.count("*").alias("periods"))
    return _fact_by_year(warehouse).withColumn("periods", members.scalar())


def run_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that a whole run could not load: those delivered without a stratum."""
    rows = fx.delivered(fx.cohort(spark, folder))
    stratum = F.col("`ESTRATO SOCIOECONÓMICO`")
    path = fresh_path(spark, "delivered-csv")
    rows.withColumn("ESTRATO SOCIOECONÓMICO", F.when(stratum != "7", stratum).otherwise("N/A")).write.option("header", True).option("escape", '"').csv(path)
    config = RunConfig(
        path, fresh_path(spark, "warehouse"), _delivered_json(spark, folder), min_year=fx.MACRO_MIN_YEAR,
        rules=[quality.not_null(schema.YEAR), quality.not_null(mart.CODE)], run_id="with gaps",
    )
    warehouse, _ = run_incremental(spark, config)
    row = F.from_json("row", f"{schema.YEAR} int, {schema.MEASURE} int")
    found = warehouse.rejects("with gaps").select("run_id", "unresolved", row.alias("row"))
    rejected = found.groupBy("run_id", "unresolved", F.col(f"row.{schema.YEAR}").alias(schema.YEAR))
    return rejected.agg(F.count("*").alias("n_rows"), F.sum(f"row.{schema.MEASURE}").alias("beneficiaries"))


def _monthly(spark: SparkSession, folder: str, second_measure) -> MonthlyRuns:
    """Raw batches: all years; then 1997 and 1998 again with the given measure; then 1998 with tripled measures."""
    landing, root = fresh_path(spark, "landing"), fresh_path(spark, "warehouse")
    small_methods(spark)
    rows, year, measure = materialize(fx.cohort(spark, folder), "cohort"), F.col(schema.YEAR), F.col(schema.MEASURE)
    rules = [
        quality.not_null(schema.YEAR),
        quality.in_set(schema.STRATUM, schema.ALLOWED_STRATA, mostly=0.80),
        quality.between(schema.MEASURE, low=0),
    ]
    macro = _delivered_json(spark, folder)
    config = RunConfig(landing, root, macro, min_year=fx.MACRO_MIN_YEAR, rules=rules)
    runs = MonthlyRuns(spark, config, f"{root}/_checkpoint")

    def land(batch: str, part: DataFrame) -> None:
        writer = fx.delivered(part).write.option("header", True).option("escape", '"')
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{landing}/batch={batch}")

    land("2024-01", rows)
    runs.run()
    land("2024-02", rows.filter(year.isin(1997, 1998)).withColumn(schema.MEASURE, second_measure(measure)))
    land("2024-03", rows.filter(year == 1998).withColumn(schema.MEASURE, measure * 3))
    runs.run()
    return runs


def monthly_run(spark: SparkSession, folder: str) -> DataFrame:
    """Three raw batches, each cleaned, merged, checked and loaded."""
    return _fact_by_year(_monthly(spark, folder, lambda measure: measure * 2).warehouse)


def gated_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The second batch holds negative measures: it is quarantined, changes nothing, and the third is loaded."""
    runs = _monthly(spark, folder, lambda measure: -measure)
    facts = _fact_by_year(runs.warehouse).select(
        F.lit("fact").alias("what"), F.col(schema.YEAR).cast("string").alias("name"), "n_rows", "beneficiaries"
    )
    held = runs.quarantined().groupBy("batch").agg(F.count("*").alias("held"))
    batches = runs.log().join(held, "batch", "left")
    return facts.union(batches.select("outcome", "batch", "delivered", F.coalesce("held", F.lit(0).cast("long"))))


# Mart and its windows


def credit_mart(spark: SparkSession, folder: str) -> DataFrame:
    fact, dimensions = _star(spark, folder)
    return plain(mart.credit_mart(fact, dimensions))


def mart_totals(spark: SparkSession, folder: str) -> DataFrame:
    fact, dimensions = _star(spark, folder)
    return plain(mart.mart_base(fact, dimensions))


def region_totals(spark: SparkSession, folder: str) -> DataFrame:
    return mart.with_region_total(_base(spark, folder))


def sector_share(spark: SparkSession, folder: str) -> DataFrame:
    return plain(mart.with_share(mart.with_region_total(_base(spark, folder))))


def yearly_change(spark: SparkSession, folder: str) -> DataFrame:
    base = _base(spark, folder).withColumn(mart.MACRO_MEAN, (F.col(mart.TOTAL) % 977 - 1).cast("decimal(19,8)"))
    return plain(mart.with_yearly_change(base))


def large_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Shares and changes of totals up to 4.5e17, whose hundredfold no long holds."""
    large = (F.col(mart.TOTAL) % 89 + 1) * F.lit(5 * 10**15) + F.col(mart.TOTAL)
    base = _base(spark, folder).withColumn(mart.MACRO_MEAN, ((F.col(mart.TOTAL) % 977 - 1) * 10**8).cast("decimal(19,8)")).withColumn(mart.TOTAL, large)
    shares = dashboard.sector_shares(base, (schema.YEAR, schema.REGION)).select(schema.YEAR, schema.REGION, schema.SECTOR, "cuota_pct")
    found = mart.with_yearly_change(mart.with_share(mart.with_region_total(base)))
    return plain(found.join(shares, [schema.YEAR, schema.REGION, schema.SECTOR], "left"))


def share_change(spark: SparkSession, folder: str) -> DataFrame:
    return plain(mart.with_share_change(mart.with_share(mart.with_region_total(_base(spark, folder)))))


def region_rank(spark: SparkSession, folder: str) -> DataFrame:
    return mart.with_rank(_base(spark, folder))


# Profiling


def distinct_regions(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_values(fx.cohort(spark, folder), schema.REGION)


def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_counts(fx.cohort(spark, folder), [f.name for f in schema.COHORT_FIELDS])


def value_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_frequencies(fx.cohort(spark, folder), schema.REGION, 10)


def null_report(spark: SparkSession, folder: str) -> DataFrame:
    return plain(profile.null_report(fx.cohort(spark, folder)))


def column_info(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_info(fx.cohort(spark, folder))


def yearly_trend(spark: SparkSession, folder: str) -> DataFrame:
    return profile.yearly_pivot(
        _staged(spark, folder), schema.YEAR, schema.SECTOR, schema.MEASURE
    ).withColumnRenamed(schema.NO_SECTOR, "NO_CLASIFICADO")


def outlier_report(spark: SparkSession, folder: str) -> DataFrame:
    """Order values rather than the evenly spread cohort measure, which has no outliers."""
    return plain(profile.outlier_report(_squared_prices(spark, folder), "value"))


def _squared_prices(spark: SparkSession, folder: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return fx.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (cents * F.col("l_quantity").cast("long") % 1000003).alias("part"),
        (F.col("l_quantity").cast("long") * F.col("l_quantity").cast("long") * cents).alias("value"),
    )


def outlier_rows(spark: SparkSession, folder: str) -> DataFrame:
    return profile.outlier_rows(_squared_prices(spark, folder), "value").select("l_orderkey", "l_linenumber", "value")


def description(spark: SparkSession, folder: str) -> DataFrame:
    stats = profile.describe(fx.cohort(spark, folder))
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    return stats.select("column", "count", *rounded)


def price_description(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of many distinct values, narrowed by sketches."""
    stats = profile.describe(fx.table(spark, folder, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"])
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    return stats.select("column", "count", *rounded)


def duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duplicate_rows(fx.cohort(spark, folder))


def measure_histogram(spark: SparkSession, folder: str) -> DataFrame:
    bins = profile.histogram(fx.cohort(spark, folder), schema.MEASURE)
    return bins.select("bin", F.round("from", 6).alias("from_value"), F.round("to", 6).alias("to_value"), "rows")


def key_range(spark: SparkSession, folder: str) -> DataFrame:
    return plain(profile.key_range(fx.cohort(spark, folder), schema.YEAR, schema.SECTOR))


def geo_key_audit(spark: SparkSession, folder: str) -> DataFrame:
    return profile.geo_key_audit(fx.macro_records(spark, folder))


def preview(spark: SparkSession, folder: str) -> DataFrame:
    return profile.preview(fx.table(spark, folder, "orders"), ["o_orderkey"], 5).select("o_orderkey", "o_custkey", "o_orderstatus")


# Quality


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.evaluate(_cohort(spark, folder), quality.standard_suite()).drop("kwargs")


def quality_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Values behind each broken rule, of the stratum rule and of a rule on the uncleaned sector."""
    rows = fx.cohort(spark, folder)
    strata = quality.in_set(schema.STRATUM, schema.ALLOWED_STRATA, mostly=schema.STRATUM_TOLERANCE)
    sectors = quality.not_null(schema.SECTOR)
    found = quality.unexpected_values(rows, strata).unionByName(quality.unexpected_values(rows, sectors))
    return found.withColumn("value", F.coalesce("value", F.lit("-")))


def quality_history(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs appended to one history: a failing one and a passing one."""
    rows, history = _cohort(spark, folder), f"{fresh_path(spark, 'history')}/{RESULTS_TABLE}"
    try:
        quality.gate(rows, quality.standard_suite(min_rows=1, max_rows=None), history, "strict")
    except quality.QualityGateError:
        pass
    quality.gate(rows, [quality.not_null(schema.YEAR)], history, "short")
    stored = spark.read.parquet(history)
    return stored.select("run_id", "rule_number", "rule", "column", "element_count", "unexpected_count", "success")


def table_constraints(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.cohort(spark, folder).withColumn(schema.MACRO_VALUE, F.col(mart.CODE) * 1e10)
    return quality.evaluate(rows, quality.table_constraints()).drop("kwargs")


def key_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    """Natural keys that repeat: none among the mart's grain, many among raw orders per customer."""
    grain = quality.duplicate_keys(_base(spark, folder), mart.GRAIN).agg(F.count("*").alias("keys"))
    raw = quality.duplicate_keys(fx.table(spark, folder, "orders"), ["o_custkey"]).agg(F.count("*").alias("keys"))
    return grain.select(F.lit("mart").alias("what"), "keys").unionByName(raw.select(F.lit("orders").alias("what"), "keys"))


# Dashboard


def _mart(spark: SparkSession, folder: str) -> DataFrame:
    fact, dimensions = _star(spark, folder)
    return mart.mart_from_base(mart.mart_base(fact, dimensions))


def yearly_evolution(spark: SparkSession, folder: str) -> DataFrame:
    return plain(dashboard.yearly_evolution(_mart(spark, folder)))


def yearly_sector_shares(spark: SparkSession, folder: str) -> DataFrame:
    return plain(dashboard.sector_shares(_base(spark, folder)))


def regional_sector_shares(spark: SparkSession, folder: str) -> DataFrame:
    return plain(dashboard.sector_shares(_base(spark, folder), (schema.YEAR, schema.REGION)))


def density_points(spark: SparkSession, folder: str) -> DataFrame:
    return plain(dashboard.density_points(_mart(spark, folder)))


def mart_slice(spark: SparkSession, folder: str) -> DataFrame:
    chosen = dashboard.mart_slice(_mart(spark, folder), years=[1999, 2000], sectors=["PRIVADO"], min_change=0)
    return plain(chosen)


def written_mart_slice(spark: SparkSession, folder: str) -> DataFrame:
    """The same slice of the mart that a warehouse has written; only the folders of the two years are read."""
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    warehouse.load(materialize(_merged_rows(spark, folder), "merged"))
    warehouse.refresh_mart()
    return plain(dashboard.mart_slice(warehouse.mart(), years=[1999, 2000], sectors=["PRIVADO"], min_change=0))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        credit_mart,
        csv_extract, csv_sniffed, macro_extract, macro_pages, page_completeness, malformed_rows, parquet_staging,
        cleaned_cohort, join_keys, accent_removal, typed_columns, macro_aliases, inferred_types, complete_rows,
        target_rows, comma_audit,
        fuzzy_mapping, mapped_names, name_scores, part_name_mapping, macro_annual, merged_macro, unmatched_audit,
        unmatched_regions, residual_nulls, macro_coverage, year_medians,
        surrogate_keys, null_safe_fact, resolved_fact, rejected_rows, star_join, orphan_keys,
        member_upsert, year_replacement, full_refresh, incremental_run, mart_refresh, monthly_batches,
        failed_load, run_rejects, monthly_run, gated_batch,
        mart_totals, region_totals, sector_share, yearly_change, large_totals, share_change, region_rank,
        distinct_regions, distinct_counts, value_frequencies, null_report, column_info, yearly_trend, outlier_report,
        outlier_rows, description, price_description, required_columns, duplicate_rows, measure_histogram, key_range, geo_key_audit, preview,
        quality_rules, quality_failures, quality_history, table_constraints, key_uniqueness,
        yearly_evolution, yearly_sector_shares, regional_sector_shares, density_points, mart_slice, written_mart_slice,
    )
}
