"""Monthly price marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed_values import MONTHLY_DIMENSIONS, STATE_DIMENSIONS
from ..staging import stage
from .derive import date_columns
from .joins import BROADCAST_ROWS, bounded_size
from .quantiles import GROUP_ROWS, counted_quantiles, group_sizes, split_by_size

PROBS = (0.25, 0.5, 0.75)
QUANTILE_COLUMNS = ("percentil_25", "preco_mediano", "percentil_75")
METRICS = (
    "preco_medio",
    "preco_mediano",
    "preco_medio_ponderado",
    "preco_minimo",
    "preco_maximo",
    "percentil_25",
    "percentil_75",
    "desvio_padrao",
    "quantidade_compras",
    "quantidade_unidades",
    "quantidade_fornecedores",
    "quantidade_orgaos",
)
PRICE, QUANTITY = "preco_normalizado", "quantidade"


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean by positive weights over rows that have both; null if there is none."""
    usable = value.isNotNull() & (weight > 0)
    return F.try_divide(F.sum(F.when(usable, value * weight)), F.sum(F.when(usable, weight)))


def _plain_metrics() -> list[Column]:
    price, quantity = F.col(PRICE), F.col(QUANTITY)
    return [
        F.avg(price).alias("preco_medio"),
        weighted_mean(price, quantity).alias("preco_medio_ponderado"),
        F.min(price).alias("preco_minimo"),
        F.max(price).alias("preco_maximo"),
        F.stddev_samp(price).alias("desvio_padrao"),
        F.count(F.lit(1)).alias("quantidade_compras"),
        F.sum(quantity).alias("quantidade_unidades"),
    ]


def _quantiles_as_columns(df: DataFrame) -> DataFrame:
    columns = {name: F.col("quantiles")[i] for i, name in enumerate(QUANTILE_COLUMNS)}
    return df.withColumns(columns).drop("quantiles")


def aggregate_prices(
    df: DataFrame,
    dimensions: Sequence[str],
    group_rows: int = GROUP_ROWS,
    sizes: DataFrame | None = None,
    clustered: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The twelve metrics per group; null dimensions form groups of their own.

    Groups are counted and numbered first. As long as they are few their numbers are
    broadcast, and rows are shuffled and compared by one number instead of all
    dimensions. ``clustered`` rows lie together by their dimensions and stay there.
    """
    dims = list(dimensions)
    counted = {"quantidade_fornecedores": "ni_fornecedor", "quantidade_orgaos": "codigo_orgao"}
    present = {name: c for name, c in counted.items() if c in df.columns}
    narrow = df.select(*dims, PRICE, QUANTITY, *present.values())
    if not clustered:
        sizes = stage(_group_numbers(narrow, dims, sizes), "groups")
    if not clustered and bounded_size(sizes, broadcast_rows) <= broadcast_rows:
        mart = _numbered_groups(narrow, sizes, dims, present, group_rows)
    else:
        split = split_by_size(narrow, dims, group_rows, sizes)
        parts = []
        if split.small is not None:
            parts.append(_small_groups(split.small, dims, present))
        if split.large is not None:
            parts.append(_large_groups(split.large, dims, present, split.large_groups))
        mart = reduce(DataFrame.unionByName, parts)
    absent = {name: F.lit(0).cast("long") for name in counted if name not in present}
    return (mart.withColumns(absent) if absent else mart).select(*dims, *METRICS)


def _group_numbers(df: DataFrame, dims: list[str], sizes: DataFrame | None) -> DataFrame:
    """Rows per group and a number for each; ``sizes`` may be of finer groups."""
    if sizes is None:
        sizes = group_sizes(df, dims)
    else:
        sizes = sizes.groupBy(*dims).agg(F.sum("__rows").alias("__rows"))
    return sizes.withColumn("__group", F.monotonically_increasing_id())


def _numbered_groups(
    df: DataFrame, groups: DataFrame, dims: list[str], counted: dict[str, str], group_rows: int
) -> DataFrame:
    """The metrics of groups whose numbers are broadcast."""
    named = groups.select("__group", "__rows", *[F.col(c).alias(f"__of_{c}") for c in dims])
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in dims))
    values = [PRICE, QUANTITY, *counted.values()]
    rows = df.join(F.broadcast(named), same).select("__group", "__rows", *values)
    large = F.col("__rows") > group_rows
    seen = groups.agg(F.count(F.lit(1)).alias("groups"), F.count_if(large).alias("large")).first()
    if seen["large"]:
        rows = stage(rows, "numbered")  # large groups are read several times
    parts = []
    if seen["large"] < seen["groups"] or not seen["groups"]:
        parts.append(_sorted_groups(rows.filter(~large), counted))
    if seen["large"]:
        parts.append(
            _large_groups(rows.filter(large).drop("__rows"), ["__group"], counted, seen["large"])
        )
    mart = reduce(DataFrame.unionByName, parts)
    return mart.join(F.broadcast(groups.select("__group", *dims)), "__group").drop("__group")


def _sorted_groups(df: DataFrame, counted: dict[str, str]) -> DataFrame:
    """Rows are shuffled once to their group and sorted there by each column: places give
    the quantiles, and values unlike the one before them the distinct counts."""
    price, group = F.col(PRICE), Window.partitionBy("__group")
    placed = df.withColumns(
        {
            "__place": F.row_number().over(group.orderBy(price.asc_nulls_last())) - 1,
            "__priced": F.count(price).over(group),
        }
    )
    first = {
        f"__first_{c}": F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.lag(c).over(group.orderBy(c)))
        for c in counted.values()
    }
    position = [(F.col("__priced") - 1) * F.lit(p) for p in PROBS]
    sides = {"low": F.floor, "high": F.ceil}
    at = {
        f"__{side}_{i}": F.max(F.when(F.col("__place") == rounded(x), price))
        for i, x in enumerate(position)
        for side, rounded in sides.items()
    }
    mart = placed.withColumns(first).groupBy("__group").agg(
        *_plain_metrics(),
        F.max("__priced").alias("__priced"),
        *[value.alias(name) for name, value in at.items()],
        *[F.count_if(f"__first_{c}").alias(name) for name, c in counted.items()],
    )
    solved = {
        name: F.col(f"__low_{i}") + (F.col(f"__high_{i}") - F.col(f"__low_{i}")) * (x - F.floor(x))
        for i, (name, x) in enumerate(zip(QUANTILE_COLUMNS, position))
    }
    return mart.withColumns(solved).drop("__priced", *at)


def _small_groups(df: DataFrame, dims: list[str], counted: dict[str, str]) -> DataFrame:
    """One aggregate. Sets are bounded by the checked group size, and a distinct
    count would multiply the rows before the shuffle."""
    probs = F.array(*[F.lit(p) for p in PROBS])
    mart = df.groupBy(*dims).agg(
        *_plain_metrics(),
        F.percentile(PRICE, probs).alias("quantiles"),
        *[F.size(F.collect_set(c)).cast("long").alias(name) for name, c in counted.items()],
    )
    return _quantiles_as_columns(mart)


def _large_groups(
    df: DataFrame, dims: list[str], counted: dict[str, str], groups: int
) -> DataFrame:
    """Plain metrics and distinct counts, which combine before each shuffle, and
    quantiles by counting; each gives one row per group, merged by grouping."""
    plain = df.groupBy(*dims).agg(
        *_plain_metrics(), *[F.count_distinct(c).alias(name) for name, c in counted.items()]
    )
    solved = counted_quantiles(df, dims, PRICE, PROBS, groups).drop("group_rows")
    both = plain.unionByName(_quantiles_as_columns(solved), allowMissingColumns=True)
    values = [c for c in both.columns if c not in dims]
    return both.groupBy(*dims).agg(*[F.max(c).alias(c) for c in values])


def with_variation(mart: DataFrame) -> DataFrame:
    """Coefficient of variation in percent, for a positive mean."""
    mean = F.col("preco_medio")
    return mart.withColumn(
        "coeficiente_variacao_pct", F.when(mean > 0, F.col("desvio_padrao") / mean * 100)
    )


def _with_dimensions(df: DataFrame, dimensions: Sequence[str], dated: bool) -> DataFrame:
    rows = df if dated else date_columns(df)
    absent = {c: F.lit(None).cast("string") for c in dimensions if c not in rows.columns}
    return rows.withColumns(absent) if absent else rows


def mart_sizes(df: DataFrame) -> DataFrame:
    """Rows per state and month. States refine the groups of the monthly mart, so one
    count tells both marts which of their groups are large."""
    return group_sizes(_with_dimensions(df, STATE_DIMENSIONS, False), STATE_DIMENSIONS)


def monthly_mart(
    df: DataFrame, group_rows: int = GROUP_ROWS, sizes: DataFrame | None = None, dated: bool = False
) -> DataFrame:
    """One row per material, unit and month. ``dated`` says that the records' own year
    and month columns hold; a table clustered by them is then not shuffled."""
    full = _with_dimensions(df, MONTHLY_DIMENSIONS, dated)
    return with_variation(aggregate_prices(full, MONTHLY_DIMENSIONS, group_rows, sizes, dated))


def state_mart(
    df: DataFrame, group_rows: int = GROUP_ROWS, sizes: DataFrame | None = None, dated: bool = False
) -> DataFrame:
    """One row per material, unit, state and month; otherwise as ``monthly_mart``."""
    full = _with_dimensions(df, STATE_DIMENSIONS, dated)
    return with_variation(aggregate_prices(full, STATE_DIMENSIONS, group_rows, sizes, dated))
