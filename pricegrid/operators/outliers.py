"""Price outliers per code and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..staging import stage
from .joins import BROADCAST_ROWS, attach_groups
from .quantiles import GROUP_ROWS, group_quantiles

GROUP = ["codigo_item_catalogo", "ano_mes"]
PRICE = "preco_normalizado"


def price_counts(df: DataFrame) -> DataFrame:
    """How often each price occurs in each code and month: ``n``. Counts of two sets of
    records add up to those of both, and limits follow from counts alone. Records
    without a price, code or month count nowhere."""
    known = df.select(*GROUP, PRICE).dropna()
    return known.groupBy(*GROUP, PRICE).agg(F.count(F.lit(1)).alias("n"))


def _flag(
    df: DataFrame,
    probs: tuple[float, float],
    outside: Column,
    reason: str,
    min_group: int,
    group_rows: int,
    broadcast_rows: int,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Attach the limits of each group and mark the prices outside of them.

    Every record with a price counts towards its group's limits, valid or not.
    Records are not shuffled as long as the limits are few. Records without a code or
    month have no group and are left out of the limits. With ``counts``, the
    ``price_counts`` of these records, the records are not read for their limits.
    """
    if counts is None:
        grouped = df.select(*GROUP, PRICE).dropna(subset=GROUP)
        stats, groups = group_quantiles(grouped, GROUP, PRICE, probs, group_rows)
    else:
        stats, groups = group_quantiles(counts, GROUP, PRICE, probs, group_rows, "n")
    limits = stats.select(
        *GROUP,
        F.col("group_rows").alias("__rows"),
        F.struct(
            F.col("group_rows").alias("n"),
            F.col("quantiles")[0].alias("low"),
            F.col("quantiles")[1].alias("high"),
        ).alias("__limits"),
    )
    if groups <= broadcast_rows:
        limits = stage(limits, "limits")  # else each read of the records solves them again
    joined = attach_groups(df, limits, GROUP, groups, "__rows", broadcast_rows)
    keyed = F.col(GROUP[0]).isNotNull() & F.col(GROUP[1]).isNotNull()
    large = F.col("__limits.n") >= min_group
    return (
        joined.withColumn("is_outlier", F.coalesce(keyed & large & outside, F.lit(False)))
        .withColumn("outlier_reason", F.when(F.col("is_outlier"), F.lit(reason)))
        .drop("__limits")
    )


def iqr_outliers(
    df: DataFrame,
    multiplier: float = 1.5,
    min_group: int = 10,
    group_rows: int = GROUP_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``is_outlier`` and ``outlier_reason`` by the interquartile range. ``counts`` are
    maintained ``price_counts`` of these records, read instead of them."""
    low, high, price = F.col("__limits.low"), F.col("__limits.high"), F.col(PRICE)
    spread = high - low
    outside = (spread > 0) & (
        (price < low - F.lit(multiplier) * spread) | (price > high + F.lit(multiplier) * spread)
    )
    reason = f"IQR_{multiplier:g}"
    return _flag(df, (0.25, 0.75), outside, reason, min_group, group_rows, broadcast_rows, counts)


def percentile_outliers(
    df: DataFrame,
    lower: float = 0.01,
    upper: float = 0.99,
    min_group: int = 10,
    group_rows: int = GROUP_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The same columns by fixed percentiles of the group."""
    price = F.col(PRICE)
    outside = (price < F.col("__limits.low")) | (price > F.col("__limits.high"))
    reason = f"PERCENTILE_{lower:g}_{upper:g}"
    return _flag(df, (lower, upper), outside, reason, min_group, group_rows, broadcast_rows)
