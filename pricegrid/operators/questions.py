"""Questions asked of the marts. Top-k orders are total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.ratios import pct_change, pct_of


def price_evolution(monthly: DataFrame, material_id: str) -> DataFrame:
    """Monthly prices and indicators of one material, in order."""
    return (
        monthly.filter(F.col("material_id") == material_id)
        .select(
            "codigo_item_catalogo",
            "material_id",
            "unidade_normalizada",
            "ano_mes",
            "preco_mediano",
            "variacao_mensal_pct",
            "variacao_yoy_pct",
            "indice_base_100",
        )
        .orderBy("ano_mes", "codigo_item_catalogo", "unidade_normalizada")
    )


def most_volatile(monthly: DataFrame, series: Sequence[str], top: int = 10) -> DataFrame:
    """Series with the highest 12-month volatility at their latest row."""
    newest = Window.partitionBy(*series).orderBy(
        *[c.desc() for c in map(F.col, _order_names(monthly, series))]
    )
    latest = (
        monthly.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")
    )
    return (
        latest.filter(F.col("volatilidade_12m").isNotNull())
        .select(*series, "ano_mes", "preco_mediano", "volatilidade_12m")
        .orderBy(F.col("volatilidade_12m").desc(), *series)
        .limit(top)
    )


def _order_names(mart: DataFrame, series: Sequence[str]) -> list[str]:
    rest = ("material", "categoria_material", "unidade_normalizada", "uf", "regiao")
    return ["ano_mes", *[c for c in rest if c in mart.columns and c not in series]]


def state_differences(state: DataFrame, monthly: DataFrame) -> DataFrame:
    """State medians against the national median of the same code, unit and month."""
    key = ["codigo_item_catalogo", "material_id", "unidade_normalizada", "ano_mes"]
    national = monthly.select(
        *[F.col(k).alias(f"__{k}") for k in key],
        *[F.col(c).alias(f"__{c}") for c in ("material", "categoria_material")],
        F.col("preco_mediano").alias("preco_nacional"),
    )
    # One national row per key and name, so the join adds no rows.
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in [*key, "material", "categoria_material"]]
    joined = state.join(national, same, "inner")
    return joined.select(
        *key,
        "uf",
        "regiao",
        "preco_mediano",
        "preco_nacional",
        pct_change(F.col("preco_mediano"), F.col("preco_nacional")).alias("diferenca_pct"),
    )


def region_prices(state: DataFrame) -> DataFrame:
    """Purchase-weighted mean price per region and month against the country's."""
    key = ["codigo_item_catalogo", "unidade_normalizada", "ano_mes"]
    amount = F.col("preco_medio") * F.col("quantidade_compras")
    regional = state.groupBy(*key, "regiao").agg(
        F.sum(amount).alias("__amount"), F.sum("quantidade_compras").alias("compras")
    )
    whole = Window.partitionBy(*key)
    mean = F.col("__amount") / F.col("compras")
    country = F.sum("__amount").over(whole) / F.sum("compras").over(whole)
    return regional.select(
        *key,
        "regiao",
        "compras",
        mean.alias("preco_medio_regiao"),
        pct_of(mean, country).alias("indice_pais_100"),
    )


def largest_increases(
    monthly: DataFrame, series: Sequence[str], first: str, last: str, top: int = 10
) -> DataFrame:
    """Series whose price rose most between their first and last month of a range."""
    keys = list(dict.fromkeys([*series, "unidade_normalizada"]))
    inside = monthly.filter(
        F.col("ano_mes").between(first, last) & F.col("preco_mediano").isNotNull()
    )
    at = F.struct("ano_mes", *[c for c in ("material", "categoria_material") if c in monthly.columns])
    ends = inside.groupBy(*keys).agg(
        F.min("ano_mes").alias("mes_inicial"),
        F.max("ano_mes").alias("mes_final"),
        F.min_by("preco_mediano", at).alias("preco_inicial"),
        F.max_by("preco_mediano", at).alias("preco_final"),
    )
    rise = pct_change(F.col("preco_final"), F.col("preco_inicial"))
    return (
        ends.withColumn("aumento_pct", rise)
        .filter("aumento_pct IS NOT NULL AND mes_inicial < mes_final")
        .orderBy(F.col("aumento_pct").desc(), *[F.col(k).asc_nulls_last() for k in keys])
        .limit(top)
    )
