"""Unit conversion of prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .joins import attach_dimension


def convert_units(df: DataFrame, conversions: DataFrame) -> DataFrame:
    """Express prices in the catalogue's unit.

    ``conversions`` has ``de``, ``para`` and ``fator``: one ``de`` is ``fator``
    times one ``para``, so a price per ``de`` is divided by it. A pair without a
    rule keeps its price and unit and is flagged; equal units need no rule.
    """
    rules = conversions.select(
        F.struct(F.lower("de").alias("de"), F.lower("para").alias("para")).alias("__pair"),
        F.col("fator").alias("__factor"),
    )
    original, wanted = F.lower("unidade_original"), F.lower("unidade_padrao")
    pair = F.when(original.isNotNull() & wanted.isNotNull(), F.struct(original.alias("de"), wanted.alias("para")))
    joined = attach_dimension(df.withColumn("__pair", pair), rules, "__pair")
    factor = F.col("__factor")
    open_pair = F.col("__pair").isNotNull() & (original != wanted)
    converted = open_pair & (factor > 0)
    unknown = F.coalesce(open_pair & ~F.coalesce(factor > 0, F.lit(False)), F.lit(False))
    return joined.withColumns(
        {
            "preco_original": F.col("preco_unitario"),
            "preco_normalizado": F.when(converted, F.col("preco_unitario") / factor).otherwise(F.col("preco_unitario")),
            "unidade_normalizada": F.when(unknown, F.col("unidade_original")).otherwise(
                F.coalesce("unidade_padrao", "unidade_original")
            ),
            "conversao_desconhecida": unknown,
        }
    ).drop("__pair", "__factor")
