"""Joins that hold up when one key has a large share of the rows.

A right side is broadcast only below a row bound that the caller has measured.
Beyond it, groups with more than an even share of the rows, of which there can
only be as many as shares, are joined by broadcast and their rows are spread over
the shuffle, so that no task receives one whole large group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..settings import DataQualityError
from ..staging import stage

BROADCAST_ROWS = 200_000
SPREAD = 4_096


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key of the right side of a many-to-one join repeats."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise DataQualityError(f"key is not unique: {repeated[0].asDict()}")


def attach_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    group_count: int,
    weight: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of ``rows`` to one row per ``keys``; a null key equals null.

    ``group_count`` is the measured number of rows of ``groups``; ``weight``
    names its column with the rows per group, which is not attached.
    """
    values = [c for c in groups.columns if c not in keys and c != weight]
    right = groups.select(*[F.col(k).alias(f"__{k}") for k in keys], *values)

    def match(side: DataFrame, extra: Column | None = None) -> Column:
        parts = [F.col(k).eqNullSafe(side[f"__{k}"]) for k in keys]
        if extra is not None:
            parts.append(extra)
        return reduce(lambda a, b: a & b, parts)

    own_keys = [f"__{k}" for k in keys]
    if group_count <= broadcast_rows:
        return rows.join(F.broadcast(right), match(right), "left").drop(*own_keys)
    if weight is None:
        raise ValueError("large group tables need a weight column")

    groups = stage(groups, "groups")  # read for the hot groups and for the others
    right = groups.select(*[F.col(k).alias(f"__{k}") for k in keys], *values)
    share = groups.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0] // SPREAD
    hot = groups.filter(F.col(weight) > share).select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.struct(*values).alias("__hot"),
    )
    with_hot = rows.join(F.broadcast(hot), match(hot), "left").drop(*own_keys)
    # Rows of hot groups are done: a spread number sends them to many tasks,
    # where they match nothing. All others carry 0, as do the groups.
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in comparable_columns(rows)]), F.lit(SPREAD)) + 1
    with_hot = with_hot.withColumn(
        "__spread", F.when(F.col("__hot").isNull(), F.lit(0).cast("long")).otherwise(spread)
    )
    cold = right.withColumn("__zero", F.lit(0).cast("long"))
    joined = with_hot.join(cold, match(cold, F.col("__spread") == F.col("__zero")), "left")
    return joined.select(
        *rows.columns,
        *[F.when(F.col("__hot").isNull(), F.col(v)).otherwise(F.col(f"__hot.{v}")).alias(v) for v in values],
    )


def comparable_columns(df: DataFrame) -> list[str]:
    """Columns that can be hashed and sorted: no maps and no variants."""
    return [
        f.name
        for f in df.schema.fields
        if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()
    ]


def bounded_size(df: DataFrame, bound: int = BROADCAST_ROWS) -> int:
    """Rows of ``df``, counted no further than one past the bound."""
    return df.limit(bound + 1).count()


def attach_dimension(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    size: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join to a table with one row per ``key``; null keys match nothing.

    A key that repeats is an error, as it would multiply rows. The dimension is
    counted first, unless the caller knows its ``size``. Beyond the bound every
    code of ``rows``, known or not, is weighed so that hot ones can be spread.
    """
    known = dimension.filter(F.col(key).isNotNull())
    require_unique(known, [key])
    if (bounded_size(dimension, broadcast_rows) if size is None else size) <= broadcast_rows:
        return rows.join(F.broadcast(known), key, "left")
    weights = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    groups = weights.join(known, key, "left")
    return attach_groups(rows, groups, [key], broadcast_rows + 1, "__rows", broadcast_rows)
