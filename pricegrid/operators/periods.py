"""The analytical period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def in_period(start_date: str, date_column: str = "data_compra") -> Column:
    """On or after the start; records without a date stay for the quality flags."""
    date = F.col(date_column)
    return date.isNull() | (date >= F.lit(start_date).cast("timestamp"))


def within_period(df: DataFrame, start_date: str) -> DataFrame:
    return df.filter(in_period(start_date))


def period_counts(df: DataFrame, start_date: str) -> DataFrame:
    """One row: records read, kept and removed by the period."""
    kept = F.count_if(in_period(start_date))
    return df.agg(
        F.count(F.lit(1)).alias("records_input"),
        kept.alias("records_kept"),
        (F.count(F.lit(1)) - kept).alias("records_removed"),
    )
