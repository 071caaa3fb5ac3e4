"""The two complete runs, from source files to loaded tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostar import schema
from regiostar.operators.clean import clean_and_standardise, map_columns, resolve_macro_columns
from regiostar.operators.merge import MacroMerge, merge_macro
from regiostar.operators.quality import Rule, gate
from regiostar.operators.typing import optimise_types
from regiostar.plans.warehouse import RESULTS_TABLE, Warehouse
from regiostar.session import fresh_path, materialize
from regiostar.sources.cohort_csv import read_cohort
from regiostar.sources.macro_records import NUMBER, PAGE_NUMBER, extract_records, landed_pages, page_report, require_complete_pages
from regiostar.sources.staging import read_staging, write_staging


@dataclass
class RunConfig:
    """Where the inputs lie, where the tables go, and the limits that apply."""

    cohort_path: str
    warehouse_root: str
    macro_path: str | None = None
    delimiter: str | None = ","
    macro_arrays: bool = False
    min_year: int = schema.MACRO_MIN_YEAR
    threshold: float = schema.MATCH_THRESHOLD
    rules: list[Rule] | None = None  # an incremental run needs them, as their row bounds depend on the delivery
    run_id: str = ""
    page_size: int | None = None  # records per landed macro page; None if the files are no numbered pages
    page_number: str = PAGE_NUMBER


def table_rows(cohort: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cohort rows under their table names and types."""
    return map_columns(cohort, schema.COHORT_FIELDS, keep=keep)


def staged_cohort(spark: SparkSession, config: RunConfig) -> DataFrame:
    cleaned = clean_and_standardise(read_cohort(spark, config.cohort_path, config.delimiter))
    return read_staging(spark, write_staging(cleaned, fresh_path(spark, "cohort")))


def staged_macro(spark: SparkSession, config: RunConfig) -> DataFrame:
    """The text records are parsed from JSON once; type inference and casts read the staged columns.

    With a page size, records of all years are staged with their page's number, and an incomplete set of pages is
    refused before any year is left out.
    """
    if config.page_size is None:
        records = extract_records(spark, config.macro_path, min_year=config.min_year, arrays=config.macro_arrays)
        return optimise_types(read_staging(spark, write_staging(records, fresh_path(spark, "macro"))))
    records = extract_records(
        spark, config.macro_path, min_year=None, arrays=config.macro_arrays, page_number=config.page_number
    )
    records = read_staging(spark, write_staging(records, fresh_path(spark, "macro")))
    require_complete_pages(page_report(records, config.page_size, landed_pages(spark, config.macro_path, config.page_number)))
    return optimise_types(records.drop(NUMBER).filter(F.col(schema.MACRO_YEAR) >= F.lit(str(config.min_year))))


def merged_cohort(cohort: DataFrame, macro: DataFrame, threshold: float) -> tuple[DataFrame, MacroMerge]:
    """Cleaned cohort with macro values under the tables' names."""
    merge = merge_macro(
        cohort,
        macro,
        year=schema.PERIOD.fields[0].source,
        region=schema.GEOGRAPHY.fields[1].source,
        threshold=threshold,
    )
    rows, _ = resolve_macro_columns(merge.rows)
    return table_rows(rows, keep=(schema.MACRO_VALUE,)), merge


def run_full_refresh(spark: SparkSession, config: RunConfig) -> Warehouse:
    """First generation: cohort file to star tables, replacing whatever was there."""
    warehouse = Warehouse(spark, config.warehouse_root)
    warehouse.replace_all(table_rows(staged_cohort(spark, config)))
    return warehouse


def run_incremental(spark: SparkSession, config: RunConfig) -> tuple[Warehouse, MacroMerge]:
    """Second generation: cohort and macro files, merged, checked, loaded by year, mart refreshed.

    The merged rows are written once; the gate and the load both read that table. Rows without all four keys are kept
    in ``warehouse.rejects(config.run_id)``.
    """
    if config.rules is None:
        raise ValueError("give the rules of the gate, such as standard_suite(min_rows=..., max_rows=...)")
    cohort, macro = staged_cohort(spark, config), staged_macro(spark, config)
    rows, merge = merged_cohort(cohort, macro, config.threshold)
    rows = materialize(rows, "merged")
    warehouse = Warehouse(spark, config.warehouse_root)
    checked = gate(rows, config.rules, f"{warehouse.root}/{RESULTS_TABLE}", config.run_id)
    warehouse.load(checked, run_id=config.run_id)
    warehouse.refresh_mart()
    return warehouse, merge
