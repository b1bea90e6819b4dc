"""Calendar labels of a purchase date; null dates give null labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def year_month(ts: Column) -> Column:
    """``yyyy-MM``; years of four digits are put together from numbers, which takes a
    fraction of a formatted date's time."""
    year, month = F.year(ts), F.month(ts)
    dash = F.when(month < 10, "-0").otherwise("-")
    plain = F.concat(year.cast("string"), dash, month.cast("string"))
    return F.when(year.between(1000, 9999), plain).otherwise(F.date_format(ts, "yyyy-MM"))


def quarter_label(ts: Column) -> Column:
    return F.concat(F.year(ts).cast("string"), F.lit("Q"), F.quarter(ts).cast("string"))


def half_label(ts: Column) -> Column:
    half = F.when(F.month(ts) <= 6, "-S1").when(F.month(ts) > 6, "-S2")
    return F.concat(F.year(ts).cast("string"), half)


def month_index(label: Column) -> Column:
    """Months since year 0 of a ``yyyy-MM`` label, for calendar distances."""
    return F.substring(label, 1, 4).cast("int") * 12 + F.substring(label, 6, 2).cast("int")
