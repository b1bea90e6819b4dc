"""Weighted price index over materials."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .joins import attach_dimension
from .marts import weighted_mean


def weighted_index(monthly: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted mean of the base-100 indices per month.

    ``weights`` has ``material_id`` and ``peso``. A month counts the materials
    that have both an index and a weight in it.
    """
    weighed = attach_dimension(monthly, weights.select("material_id", "peso"), "material_id")
    index, weight = F.col("indice_base_100"), F.col("peso")
    return (
        weighed.groupBy("ano_mes")
        .agg(
            weighted_mean(index, weight).alias("indice_ponderado"),
            F.count_if(index.isNotNull() & (weight > 0)).alias("observacoes"),
        )
        .filter("observacoes > 0")
    )
