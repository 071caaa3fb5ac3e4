"""Lenient number and date parsing, and exact ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar.functions.text import strip

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^(?i)[+-]?(inf|infinity)$"
# Date layouts tried in turn, month before day.
DATE_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy", "MM-dd-yyyy")


def to_number(col: Column) -> Column:
    """Text to double, null if it is no number. Java's own parser would also take ``1d``, ``2f`` or ``0x1p3``.

    Texts between a sign, point or digit and a point or digit, the usual case, cannot hold any of these but the last, and need no pattern.
    """
    text = strip(col)
    matched = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    last = F.right(col, F.lit(1))
    usual = (col >= "+") & (col < ":") & (last >= ".") & (last < ":") & ~F.contains(F.lower(col), F.lit("x"))
    return F.when(usual, col.try_cast("double")).otherwise(matched)


def numeric(df: DataFrame, name: str) -> Column:
    """The column as a double: parsed if it is text, cast if it is a number already."""
    col = F.col(f"`{name}`")
    return col.cast("double") if isinstance(df.schema[name].dataType, T.NumericType) else to_number(col.cast("string"))


def whole(number: Column) -> Column:
    """Double to int, null if it has a fraction or does not fit; ``2018.0`` counts as 2018."""
    return F.when(number == F.floor(number), number).try_cast("int")


def to_integer(col: Column) -> Column:
    """Text to int, null if it is no whole number.

    Digits with or without a sign, the usual case, are cast at once; a cast alone would also drop control characters at the ends.
    """
    plain = (col >= "+") & (col < ":") & F.right(col, F.lit(1)).between("0", "9")
    return F.coalesce(F.when(plain, col.try_cast("int")), whole(to_number(col)))


def integer(df: DataFrame, name: str) -> Column:
    """The column as an int, without parsing where it is a whole number already."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.col(f"`{name}`").cast("int")
    return whole(numeric(df, name))


def to_moment(col: Column) -> Column:
    """Text to timestamp, null if no known layout fits."""
    parsed = [F.try_to_timestamp(col)]
    parsed += [F.try_to_timestamp(col, F.lit(layout)) for layout in DATE_LAYOUTS]
    return F.coalesce(*parsed)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded half away from zero; null where the denominator is zero or null.

    24 digits leave the quotient at least 14 decimals, so rounding twice cannot shift a result.
    """
    quotient = numerator.cast("decimal(24,0)") / F.nullif(denominator, F.lit(0)).cast("decimal(24,0)")
    return F.round(quotient, digits)


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """As a decimal of 24 digits, so that the product of a long cannot overflow."""
    return ratio(numerator.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)"), denominator, digits)
