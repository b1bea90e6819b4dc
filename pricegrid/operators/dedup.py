"""Keep-last deduplication with a fixed order.

``row_number() = 1`` over the key becomes a partial limit before the shuffle,
so a key with very many copies sends one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed_values import TECHNICAL_KEY
from .joins import comparable_columns

# What "last" means, most important first; absent columns are left out.
RECENCY = ("ingestion_timestamp", "_bronze_object", "_page")


def recency_order(df: DataFrame, order: Sequence[str] = RECENCY) -> list[Column]:
    """Newest first, and a total order: equal rows only tie with themselves."""
    first = [c for c in order if c in df.columns]
    rest = sorted(c for c in comparable_columns(df) if c not in first)
    return [F.col(c).desc_nulls_last() for c in [*first, *rest]]


def keep_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """The newest row per key; rows whose keys are all null are one group."""
    newest = list(order) if order is not None else recency_order(df)
    window = Window.partitionBy(*keys).orderBy(*newest)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def dedup_keys(df: DataFrame) -> list[str]:
    """Key columns by priority: the hash if any is set, else the key parts in use.

    An empty list means that whole rows are compared.
    """
    if "record_hash" in df.columns and not df.filter("record_hash IS NOT NULL").isEmpty():
        return ["record_hash"]
    parts = [k for k in TECHNICAL_KEY if k in df.columns]
    if not parts:
        return []
    used = df.agg(*[F.bool_or(F.col(k).isNotNull()).alias(k) for k in parts]).first()
    return [k for k in parts if used[k]]


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order: Sequence[Column | str] | None = None,
    null_hash: str = "group",
) -> DataFrame:
    """Drop repeated records.

    ``keys`` skips the choice of ``dedup_keys``. Records without a hash count as
    copies of each other (``null_hash="group"``) or all stay (``"keep"``).
    """
    chosen = dedup_keys(df) if keys is None else list(keys)
    if not chosen:
        return df.dropDuplicates()
    if chosen == ["record_hash"] and null_hash == "keep":
        hashed = df.filter("record_hash IS NOT NULL")
        return keep_last(hashed, chosen, order).unionByName(df.filter("record_hash IS NULL"))
    return keep_last(df, chosen, order)
