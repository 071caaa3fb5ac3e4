"""Cohort files: headed CSV with thousands separators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar import schema
from regiostar.functions.numbers import to_integer
from regiostar.functions.text import drop_thousands
from regiostar.session import small_methods
from regiostar.sources.columns import strip_column_names

DELIMITERS = (",", ";", "\t", "|")
# The year stays text until cleaning; the other integer columns are read as numbers.
NUMERIC_SOURCES = tuple(
    f.source for f in schema.COHORT_FIELDS if f.type == "int" and f.name != schema.YEAR
)


def header_line(spark: SparkSession, path: str) -> str:
    """First line of the file; a missing file raises here."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"{path} holds no header line")
    return first[0][0].lstrip("﻿")


def split_header(line: str, delimiter: str) -> list[str]:
    names, current, quoted = [], "", False
    for char in line:
        if char == '"':
            quoted = not quoted
        elif char == delimiter and not quoted:
            names.append(current)
            current = ""
        else:
            current += char
    return names + [current]


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The candidate that cuts the header line into most columns."""
    line = header_line(spark, path)
    return max(DELIMITERS, key=lambda d: len(split_header(line, d)))


REJECTED, REASON, FILE = "_rejected", "_reason", "_file"
BOM = "\ufeff"


def read_csv_rows(
    spark: SparkSession, path: str, delimiter: str | None = ",", multiline: bool = False, names: Iterable[str] | None = None
) -> DataFrame:
    """All rows as text with their file, and for a row that can't be cut into the columns its line and the reason.

    Too many fields, and a quote that stays open, are reasons; missing fields at the end are nulls, blank lines no rows.
    ``names`` is for files without a header. Lines are read as text and cut in the same scan, which gives both kinds of
    rows. Rows over several lines (``multiline``) are read by the CSV source, where an open quote runs to the file's end.
    """
    header = header_line(spark, path) if names is None or delimiter is None else ""
    if delimiter is None:
        delimiter = max(DELIMITERS, key=lambda d: len(split_header(header, d)))
    named = list(names) if names is not None else split_header(header, delimiter)
    if not multiline:
        df = spark.read.text(path).select(F.ltrim(F.col("value"), F.lit(BOM)).alias("line"), F.col("_metadata.file_name").alias(FILE))
        if names is None:
            df = df.filter(F.col("line") != header)  # the first line of every file
        return cut_lines(df, named, delimiter)
    places = _places(named)
    columns = T.StructType([T.StructField(c, T.StringType()) for c in [*places, REJECTED]])
    options = {**_options(delimiter), "multiLine": True, "columnNameOfCorruptRecord": REJECTED}
    df = spark.read.schema(columns).options(header=names is None, **options).csv(path)
    df = df.select("*", F.col("_metadata.file_name").alias(FILE))
    return _accounted(df, [F.col(c) for c in places], F.col(REJECTED), named, delimiter)


def _places(names: list[str]) -> list[str]:
    return [f"c{i}" for i in range(len(names))]


def _options(delimiter: str) -> dict[str, str]:
    return {"sep": delimiter, "quote": '"', "escape": '"'}


def cut_lines(lines: DataFrame, names: Iterable[str], delimiter: str = ",", keep: Iterable[str] = ()) -> DataFrame:
    """Rows as ``read_csv_rows`` gives them, from a ``line`` with its ``_file`` and columns to ``keep``; blank lines are no rows."""
    named, kept_too = list(names), list(keep)
    cut = F.from_csv("line", ", ".join(f"{c} string" for c in _places(named)), _options(delimiter))
    df = lines.filter(F.trim("line") != "").select("line", FILE, *kept_too, cut.alias("cut"))
    return _accounted(df, [F.col(f"cut.{c}") for c in _places(named)], F.col("line"), named, delimiter, kept_too)


def _accounted(df: DataFrame, fields: list[Column], line: Column, names: list[str], delimiter: str, keep: Iterable[str] = ()) -> DataFrame:
    # Delimiters inside quotes are none; a doubled quote looks like two quoted parts side by side.
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, '"[^"]*"', "")).otherwise(line)
    count = F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1
    reason = F.when(F.contains(bare, F.lit('"')), "open quote").when(count > len(names), "too many fields")
    texts = [F.when(~field.isin(*schema.NULL_TOKENS), field).alias(name) for field, name in zip(fields, names, strict=True)]
    return df.select(*texts, F.when(reason.isNotNull(), line).alias(REJECTED), reason.alias(REASON), FILE, *keep)


def kept(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(REASON).isNull()).drop(REJECTED, REASON, FILE)


def rejected(rows: DataFrame) -> DataFrame:
    """File, reason and line of every row that was left out."""
    return rows.filter(F.col(REASON).isNotNull()).select(FILE, REASON, REJECTED)


def read_csv_text(spark: SparkSession, path: str, delimiter: str | None = ",", multiline: bool = False) -> DataFrame:
    """All columns as text; a row that can't be cut into the columns is an error.

    ``delimiter=None`` takes the delimiter from the header line. The schema also comes from the header, so the
    files are read once. ``multiline`` allows line breaks within quotes, but such files cannot be split.
    """
    rows = read_csv_rows(spark, path, delimiter, multiline)
    message = F.concat(F.col(FILE), F.lit(": "), F.col(REASON), F.lit(": "), F.col(REJECTED))
    return rows.filter(F.when(F.col(REASON).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)).drop(REJECTED, REASON, FILE)


def extract_csv(
    spark: SparkSession,
    path: str,
    delimiter: str | None = ",",
    numeric: Iterable[str] = NUMERIC_SOURCES,
    multiline: bool = False,
) -> DataFrame:
    """Read a cohort file: numeric columns lose their thousands separators, the year stays text.

    The numeric columns are declared, not inferred, which saves a pass over the files. A value that is
    no number becomes null.
    """
    return whole_numbers(read_csv_text(spark, path, delimiter, multiline), numeric)


def whole_numbers(df: DataFrame, numeric: Iterable[str] = NUMERIC_SOURCES) -> DataFrame:
    """Text columns with the stated ones as whole numbers, without thousands separators."""
    small_methods(df.sparkSession)
    wanted = set(numeric)
    return df.select(
        *[
            to_integer(drop_thousands(F.col(f"`{n}`"))).alias(n) if n.strip() in wanted else F.col(f"`{n}`")
            for n in df.columns
        ]
    )


def read_cohort(spark: SparkSession, path: str, delimiter: str | None = ",") -> DataFrame:
    return strip_column_names(extract_csv(spark, path, delimiter))
