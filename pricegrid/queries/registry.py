"""Registered queries: a callable and, where SQL can say it, its twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

DIGITS = 4


def query(name: str, twin: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if twin is not None:
            TWINS[name] = twin
        return function

    return add


# Above this a double times ten to the DIGITS has no exact whole part.
_EXACT = 1e11


def rounded_value(col: Column) -> Column:
    """``round`` of a double, half away from zero. Spark's own goes by way of decimal text
    and is only taken for values beyond whole numbers' exact range."""
    scaled = F.abs(col) * F.lit(10.0**DIGITS)
    below = F.floor(scaled)
    whole = below + F.when(scaled - below >= 0.5, 1).otherwise(0)
    near = F.signum(col) * whole / F.lit(10.0**DIGITS)
    return F.when(F.abs(col) < _EXACT, near).otherwise(F.round(col, DIGITS)) + F.lit(0.0)


def comparable(df: DataFrame) -> DataFrame:
    """Round doubles, as sums differ in their last digits between engines, and
    show timestamps as wall-clock times."""
    shown = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            col = rounded_value(col)
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        shown.append(col.alias(field.name))
    return df.select(*shown)


def rounded(*names: str) -> str:
    """The twin's select list for double columns."""
    return ", ".join(f"round({n}, {DIGITS}) + 0.0 AS {n}" for n in names)
