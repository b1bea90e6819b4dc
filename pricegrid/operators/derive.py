"""Columns derived from a typed, enriched record."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import REGION_BY_UF
from ..functions.calendar import half_label, quarter_label, year_month


def region_of(uf: Column) -> Column:
    """Macro-region of a federative unit; null when unknown."""
    table = F.create_map(*[F.lit(x) for x in chain(*REGION_BY_UF.items())])
    return F.try_element_at(table, uf)


def date_columns(df: DataFrame, date_column: str = "data_compra") -> DataFrame:
    date = F.col(date_column)
    return df.withColumns(
        {"ano": F.year(date), "mes": F.month(date), "ano_mes": year_month(date)}
    )


def derived_columns(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Total value, calendar labels, region and normalised price and unit."""
    date = F.col("data_compra")
    return date_columns(df).withColumns(
        {
            "valor_total_item": F.col("quantidade") * F.col("preco_unitario"),
            "trimestre": quarter_label(date),
            "semestre": half_label(date),
            "regiao": region_of(F.col("uf")),
            "preco_original": F.col("preco_unitario"),
            "preco_normalizado": F.col("preco_unitario"),
            "unidade_normalizada": F.coalesce("unidade_padrao", "unidade_original"),
            "_silver_processed_at": F.current_timestamp() if processed_at is None else processed_at,
        }
    )
