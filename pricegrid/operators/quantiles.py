"""Exact interpolated quantiles per group.

Two ways to the same values. Groups up to a size use Spark's ``percentile``,
which holds the values of a group in one task. Larger ones are solved by
counting: values are put into narrow bands that keep their order, running counts
over the bands of a group show which band holds a wanted rank, that band is
split once more, and only the values of the last narrow range are numbered. All
its steps are partial aggregates or windows over bounded counts, so a group may
hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..staging import stage
from .joins import BROADCAST_ROWS

GROUP_ROWS = 1_000_000
# Bands per unit of log(value): neighbours differ by about 0.4 percent.
BANDS_PER_LOG = 256
ZERO_OFFSET = 200_000
SPLITS = 4_096


@dataclass(frozen=True)
class GroupSplit:
    """Rows of groups that fit into a task, and of groups that may not."""

    small: DataFrame | None
    large: DataFrame | None
    groups: int
    large_groups: int


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))


def split_by_size(
    df: DataFrame,
    keys: Sequence[str],
    group_rows: int = GROUP_ROWS,
    sizes: DataFrame | None = None,
) -> GroupSplit:
    """Count the groups by one small job and tell large ones apart. ``sizes`` are
    ``group_sizes`` by these or more keys that are known already.

    The keys of large groups are few, as each stands for many rows; they are
    broadcast after a check of their number. If they are too many, or all groups
    are large, every row counts as large.
    """
    if sizes is None:
        sizes = group_sizes(df, keys)
    else:
        sizes = sizes.groupBy(*keys).agg(F.sum("__rows").alias("__rows"))
    large = F.col("__rows") > group_rows
    seen = sizes.agg(F.count(F.lit(1)).alias("groups"), F.count_if(large).alias("large")).first()
    groups, many = seen["groups"], seen["large"]
    if not many:
        return GroupSplit(df, None, groups, 0)
    if many == groups or many > BROADCAST_ROWS:
        return GroupSplit(None, df, groups, many)
    named = [F.col(k).alias(f"__of_{k}") for k in keys]
    hot = F.broadcast(stage(sizes.filter(large).select(*named), "large-groups"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys))
    return GroupSplit(df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi"), groups, many)


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    group_rows: int = GROUP_ROWS,
    frequency: str | None = None,
) -> tuple[DataFrame, int]:
    """``keys``, ``group_rows`` and ``quantiles`` (one per prob) of the non-null
    values, and the number of groups. With ``frequency`` a row stands for as many."""
    columns = [*keys, value] if frequency is None else [*keys, value, frequency]
    split = split_by_size(df.select(*columns), keys, group_rows)
    parts = []
    if split.small is not None:
        parts.append(held_quantiles(split.small, keys, value, probs, frequency))
    if split.large is not None:
        parts.append(counted_quantiles(split.large, keys, value, probs, split.large_groups, frequency))
    return reduce(DataFrame.unionByName, parts), split.groups


def held_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], frequency: str | None = None
) -> DataFrame:
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    many = F.lit(1) if frequency is None else F.col(frequency)
    rows = F.count(value) if frequency is None else F.coalesce(F.sum(F.when(F.col(value).isNotNull(), many)), F.lit(0))
    return df.groupBy(*keys).agg(
        rows.alias("group_rows"),
        F.percentile(value, wanted, many).alias("quantiles"),
    )


def value_band(value: Column) -> Column:
    """Whole number that never falls as ``value`` rises."""
    size = F.floor(F.log(F.abs(value)) * BANDS_PER_LOG) + ZERO_OFFSET
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0)).cast("long")


def counted_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    group_count: int,
    frequency: str | None = None,
) -> DataFrame:
    keys = list(keys)
    many = F.lit(1).cast("long") if frequency is None else F.col(frequency).cast("long")
    named = df.select(*keys, F.col(value).cast("double").alias("__v"), many.alias("__many"))
    known = named.filter(F.col("__v").isNotNull())
    spans = group_count * 2 * len(probs)
    # Equal values fold before they are shuffled; the hash covers the value.
    counted = (
        known.withColumn("__band", value_band(F.col("__v")))
        .groupBy(*keys, "__band", "__v")
        .agg(F.sum("__many").alias("__n"))
    )

    bands = counted.groupBy(*keys, "__band").agg(*_range_stats())
    bands = bands.withColumn("__total", F.sum("__n").over(Window.partitionBy(*keys)))
    bands = _with_ranks_before(bands.withColumn("__start", F.lit(0)), keys, "__band")
    held = _holding(bands, probs).select(
        *keys, "__band", "__total", F.col("__before").alias("__start"), "__low", "__high"
    )

    level = [*keys, "__band"]
    inside = _within(counted, held, level, spans)
    width = F.col("__high") - F.col("__low")
    share = F.when(width > 0, (F.col("__v") - F.col("__low")) / width).otherwise(F.lit(0.0))
    inside = inside.withColumn("__split", F.floor(share * SPLITS)).drop("__low", "__high")
    splits = inside.groupBy(*level, "__split", "__total", "__start").agg(*_range_stats())
    held = _holding(_with_ranks_before(splits, level, "__split"), probs).select(
        *level, "__split", F.col("__before").alias("__first")
    )

    level = [*level, "__split"]
    last = _within(inside, held, level, spans).withColumn("__start", F.col("__first"))
    found = _holding(_with_ranks_before(last, level, "__v"), probs)
    return _complete(_interpolated(found, keys, probs), named, keys)


def _range_stats() -> list[Column]:
    return [
        F.sum("__n").alias("__n"),
        F.min("__v").alias("__low"),
        F.max("__v").alias("__high"),
    ]


def _with_ranks_before(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``__before``: rank, from 0, of the first value this row stands for."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = F.sum("__n").over(frame) - F.col("__n")
    return df.withColumn("__before", F.col("__start") + ahead)


def _position(p: float) -> Column:
    return (F.col("__total") - 1) * F.lit(float(p))


def _holding(df: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Rows that stand for a wanted rank, on either side of a wanted position."""
    ranks = [f(_position(p)).cast("long") for p in probs for f in (F.floor, F.ceil)]
    end = F.col("__before") + F.col("__n")
    inside = [(r >= F.col("__before")) & (r < end) for r in ranks]
    return df.filter(reduce(lambda a, b: a | b, inside))


def _within(values: DataFrame, spans: DataFrame, keys: list[str], span_rows: int) -> DataFrame:
    """Values that fall into one of the spans, with the span's columns."""
    carried = [c for c in spans.columns if c not in keys]
    right = spans.select(*[F.col(k).alias(f"__of_{k}") for k in keys], *carried)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys))
    if span_rows <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return values.join(right, same).select(*values.columns, *carried)


def _interpolated(found: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Bring the values at the wanted ranks together: two per prob and group."""
    end = F.col("__before") + F.col("__n")

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("__before")) & (rank < end), F.col("__v")))

    sides = {"low": F.floor, "high": F.ceil}
    values = found.groupBy(*keys, "__total").agg(
        *[
            value_at(side(_position(p)).cast("long")).alias(f"__{name}_{i}")
            for i, p in enumerate(probs)
            for name, side in sides.items()
        ]
    )

    def quantile(i: int, p: float) -> Column:
        low, high = F.col(f"__low_{i}"), F.col(f"__high_{i}")
        return low + (high - low) * (_position(p) - F.floor(_position(p)))

    solved = F.array(*[quantile(i, p) for i, p in enumerate(probs)])
    return values.select(*keys, F.col("__total").alias("group_rows"), solved.alias("quantiles"))


def _complete(solved: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add the groups that have no value at all."""
    empty = (
        rows.groupBy(*keys)
        .agg(F.count("__v").alias("group_rows"))
        .filter("group_rows = 0")
        .withColumn("quantiles", F.lit(None).cast("array<double>"))
    )
    return solved.unionByName(empty)
