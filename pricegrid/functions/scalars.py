"""Cleaning of codes, numbers, dates and text.

Each function takes the column and its Spark type, because text and already
typed columns follow different rules.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, functions as F, types as T

# Every character Unicode counts as white space, as Python's strip() does.
WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def strip(col: Column) -> Column:
    """Trim white space of any kind, not only blanks."""
    return F.btrim(col, F.lit(WHITESPACE))


def catalogue_code(col: Column, dtype: T.DataType) -> Column:
    """Code as text, without a trailing ``.0``; empty becomes null."""
    text = col.cast("string")
    if isinstance(dtype, _FRACTIONAL):
        # Whole numbers print without exponent or fraction.
        whole = F.when(col == F.floor(col), F.floor(col).cast("string")).otherwise(text)
        text = F.when(F.isnan(col.cast("double")), None).otherwise(whole)
    return F.nullif(F.regexp_replace(strip(text), r"\.0$", ""), F.lit(""))


def local_number(col: Column, dtype: T.DataType) -> Column:
    """Number from text with ``.`` for thousands and ``,`` for decimals."""
    if isinstance(dtype, T.NumericType):
        number = col.cast("double")
        return F.when(F.isnan(number), None).otherwise(number)
    text = strip(col.cast("string"))
    text = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    # An extract names the text once, so it is not worked out again for the cast.
    return F.regexp_extract(text, _NUMBER, 0).try_cast("double")


def local_text(col: Column) -> Column:
    """A number as text that ``local_number`` and ``catalogue_code`` read as the same
    number: whole ones without a fraction, others with a decimal comma."""
    number = col.cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    other = F.translate(number.cast("string"), ".", ",")
    return F.when(whole, number.cast("bigint").cast("string")).when(~F.isnan(number), other)


def plain_number(col: Column, dtype: T.DataType) -> Column:
    """Number from text with a decimal point; anything else becomes null."""
    if isinstance(dtype, T.NumericType):
        number = col.cast("double")
        return F.when(F.isnan(number), None).otherwise(number)
    text = strip(col.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def utc_timestamp(
    col: Column, dtype: T.DataType, formats: tuple[str, ...] = ("yyyyMMdd",)
) -> Column:
    """Timestamp in UTC from ISO text (or ``formats``); unreadable becomes null."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    text = strip(col.cast("string"))
    # A cast also takes a bare time of day and dates it today; ask for a year.
    iso = F.when(text.rlike("^[0-9]{4}(-|$)"), text.try_cast("timestamp"))
    return F.coalesce(iso, *(F.try_to_timestamp(text, F.lit(f)) for f in formats))
