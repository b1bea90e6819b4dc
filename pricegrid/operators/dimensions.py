"""Dimension tables and material eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import half_label, quarter_label, year_month


def material_dimension(silver: DataFrame) -> DataFrame:
    """One row per code and material seen in the records."""
    return silver.select(
        "codigo_item_catalogo", "material_id", "material", "categoria_material", "unidade_padrao"
    ).distinct()


def date_dimension(df: DataFrame, date_column: str = "data_compra") -> DataFrame:
    """One row per day from the first to the last purchase, with its labels."""
    day = F.to_date(F.col(date_column))
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).filter("first IS NOT NULL")
    days = span.select(F.explode(F.sequence("first", "last")).alias("data"))
    date = F.col("data")
    return days.select(
        date,
        F.year(date).alias("ano"),
        F.month(date).alias("mes"),
        F.dayofmonth(date).alias("dia"),
        year_month(date).alias("ano_mes"),
        quarter_label(date).alias("trimestre"),
        half_label(date).alias("semestre"),
    )


def eligible_materials(
    silver: DataFrame, min_records: int = 10, start_date: str = "2020-01-01", min_months: int = 2
) -> DataFrame:
    """Codes with enough valid records since the start, a unit and a history."""
    usable = silver.filter(
        F.col("is_valid_record")
        & F.col("unidade_normalizada").isNotNull()
        & (F.col("data_compra") >= F.lit(start_date).cast("timestamp"))
    )
    return (
        usable.groupBy("codigo_item_catalogo")
        .agg(
            F.count(F.lit(1)).alias("registros"),
            F.count_distinct("ano_mes").alias("meses"),
            F.min("ano_mes").alias("primeiro_mes"),
            F.max("ano_mes").alias("ultimo_mes"),
        )
        .filter((F.col("registros") >= min_records) & (F.col("meses") >= min_months))
    )
