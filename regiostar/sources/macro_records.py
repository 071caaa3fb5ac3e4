"""Macro records: pages of JSON text records that a fetcher has landed in a folder."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar import schema
from regiostar.session import materialize

PAGE, REJECTED = "_page", "_rejected"
NUMBER, RECORDS, MISSING, OUTCOME = "page_number", "records", "missing_before", "outcome"
PAGE_NUMBER = r"(\d+)[^\d/]*$"  # the last digits of a path: p12.json is page 12
TASKS = 1_000  # tasks that read page files; more cores use more
PAGES_AT_ONCE = 10_000  # page numbers that one task compares; fewer pages would need no split


class IncompletePages(RuntimeError):
    """Pages are missing, cut short or have no number."""


def gathered(files: DataFrame, tasks: int = TASKS) -> DataFrame:
    """Rows of many small files, read by a limited number of tasks: Spark gives each task a few files, whatever they hold."""
    limit = max(tasks, 4 * files.sparkSession.sparkContext.defaultParallelism)
    return files.coalesce(limit) if files.rdd.getNumPartitions() > limit else files


def read_records(
    spark: SparkSession,
    path: str,
    year_column: str = schema.MACRO_YEAR,
    min_year: int | str | None = schema.MACRO_MIN_YEAR,
    columns: Iterable[str] = schema.MACRO_RECORD_COLUMNS,
    arrays: bool = False,
    page_number: str | None = None,
) -> DataFrame:
    """All fields as text, with the name of the page; the year is compared as text.

    Pages hold one record per line, or with ``arrays`` one JSON array each. Broken JSON is an error. With a pattern
    such as ``PAGE_NUMBER``, whose group finds the digits in the file's path, each record also carries its page's number.
    """
    fields = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    df = spark.read.schema(fields).option("multiLine", arrays).option("mode", "FAILFAST").json(path)
    number = [] if page_number is None else [number_of(F.col("_metadata.file_path"), page_number).alias(NUMBER)]
    df = gathered(df.select("*", F.col("_metadata.file_name").alias(PAGE), *number))
    if min_year is None:
        return df
    return df.filter(F.col(year_column) >= F.lit(str(min_year)))


def read_record_rows(spark: SparkSession, path: str, columns: Iterable[str] = schema.MACRO_RECORD_COLUMNS) -> DataFrame:
    """Every line with its page: the fields, or the line itself in ``_rejected`` where it is no JSON record.

    No year is filtered here, so that kept and rejected lines add up to what was delivered.
    """
    names = list(columns)
    fields = T.StructType([T.StructField(name, T.StringType()) for name in [*names, REJECTED]])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED})
    df = lines.select("value", parsed.alias("record"), F.col("_metadata.file_name").alias(PAGE))
    broken = F.col("record").isNull() | F.col(f"record.{REJECTED}").isNotNull()
    return df.select(*[F.col(f"record.`{n}`").alias(n) for n in names], F.when(broken, F.col("value")).alias(REJECTED), PAGE)


def kept(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(REJECTED).isNotNull()).select(PAGE, REJECTED)


def extract_records(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records without the page name; no record at all is an error."""
    df = read_records(spark, path, **options).drop(PAGE)
    if df.isEmpty():
        raise RuntimeError(f"no macro records in {path}; check the folder and the year column")
    return df


def page_counts(records: DataFrame) -> DataFrame:
    return records.groupBy(PAGE).agg(F.count("*").alias("records"))


def incomplete_pages(records: DataFrame, page_size: int = schema.PAGE_SIZE) -> DataFrame:
    """Pages with fewer records than the page size, other than the last: reading stopped too early there.

    The last page is that of the highest number in its name, of equal ones the last in text order.
    """
    counts = page_counts(records)
    last = counts.agg(F.max(F.struct(number_of(F.col(PAGE)), PAGE))).scalar()
    return counts.filter((F.col("records") < page_size) & (F.struct(number_of(F.col(PAGE)), PAGE) != last))


def number_of(path: Column, pattern: str = PAGE_NUMBER) -> Column:
    """Digits in a path as a number; null where there are none or too many for a long."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).try_cast("long")


def landed_pages(spark: SparkSession, path: str, page_number: str = PAGE_NUMBER) -> DataFrame:
    """Numbers of all page files, those without a record too; reads the listing, not the files.

    Spark lists no file of zero bytes, so such a page counts as missing.
    """
    files = gathered(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path))
    return files.select(number_of(F.col("path"), page_number).alias(NUMBER)).distinct()


def page_report(
    records: DataFrame, page_size: int = schema.PAGE_SIZE, pages: DataFrame | None = None, block: int = PAGES_AT_ONCE
) -> DataFrame:
    """A row per page: its number, its records, how many numbers are missing before it, and the outcome.

    Outcomes: ``last`` (the highest number, with as many records as the page size or fewer), ``whole``, ``cut short``,
    ``too many``, and ``unnumbered`` for all records of files without a number. ``records`` come from ``read_records``
    with a ``page_number`` and without a year filter, as that would shorten pages. Pages may start at 0 or 1. Files that
    share a number are one page. ``pages`` (see ``landed_pages``) adds files without a record; an empty page before the
    last is cut short. Neighbours are compared in blocks of numbers, and then between blocks, so no task sees all pages.
    """
    counts = records.groupBy(NUMBER).agg(F.count("*").alias(RECORDS))
    if pages is not None:
        counts = counts.unionByName(pages.select(NUMBER, F.lit(0).cast("long").alias(RECORDS)))
        counts = counts.groupBy(NUMBER).agg(F.sum(RECORDS).alias(RECORDS))
    counts = materialize(counts, "page-counts")  # else every use reads the files again
    blocked = counts.withColumn("_block", F.floor(F.col(NUMBER) / block))
    ends = blocked.filter(F.col(NUMBER).isNotNull()).groupBy("_block").agg(F.max(NUMBER).alias("_end"))
    before = ends.select("_block", F.lag("_end").over(W.orderBy("_block")).alias("_before"))
    previous = F.coalesce(F.lag(NUMBER).over(W.partitionBy("_block").orderBy(NUMBER)), "_before")
    last = ends.agg(F.max("_end")).scalar()
    number = F.col(NUMBER)
    missing = F.when(previous.isNull(), F.greatest(number - 1, F.lit(0))).otherwise(number - previous - 1)
    outcome = (
        F.when(number.isNull(), "unnumbered").when(F.col(RECORDS) > page_size, "too many").when(number == last, "last")
        .when(F.col(RECORDS) < page_size, "cut short").otherwise("whole")
    )
    return blocked.join(before, "_block", "left").select(
        NUMBER, RECORDS, F.when(number.isNotNull(), missing).alias(MISSING), outcome.alias(OUTCOME)
    )


def require_complete_pages(report: DataFrame, listed: int = 20) -> None:
    """Raise if a page is missing, cut short, too long or unnumbered; the message names the first ones."""
    wrong = report.filter((F.col(MISSING) > 0) | ~F.col(OUTCOME).isin("whole", "last"))
    found = wrong.orderBy(NUMBER).limit(listed).collect()
    if found:
        lines = [f"page {r[NUMBER]}: {r[OUTCOME]}, {r[RECORDS]} records, {r[MISSING]} pages missing before it" for r in found]
        raise IncompletePages("\n".join(["the macro pages are incomplete", *lines]))
