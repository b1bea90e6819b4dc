"""Validity flags, issue lists, run metrics and checks that stop a run."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import ISSUE_CODES, REGION_BY_UF, REQUIRED_FOR_MARTS, TECHNICAL_KEY
from ..functions.scalars import plain_number
from ..settings import DataQualityError, SchemaError
from .periods import period_counts


def _positive(name: str) -> Column:
    return F.coalesce(F.col(name) > 0, F.lit(False))


def quality_flags(df: DataFrame) -> DataFrame:
    """Five flags, their conjunction and the list of issues; no row is dropped."""
    code, uf = F.col("codigo_item_catalogo"), F.col("uf")
    flags = {
        "is_valid_catmat": F.coalesce(code != "", F.lit(False)),
        "is_valid_date": F.col("data_compra").isNotNull(),
        "is_valid_price": _positive("preco_unitario"),
        "is_valid_quantity": _positive("quantidade"),
        "is_valid_uf": uf.isNull() | uf.isin(*REGION_BY_UF),
    }
    issues = F.concat_ws(";", *[F.when(~F.col(f), code) for f, code in ISSUE_CODES.items()])
    return (
        df.withColumns(flags)
        .withColumn("is_valid_record", reduce(lambda a, b: a & b, map(F.col, ISSUE_CODES)))
        .withColumn("quality_issues", F.nullif(issues, F.lit("")))
    )


def silver_metrics(canonical: DataFrame, silver: DataFrame, start_date: str) -> DataFrame:
    """One row: records in and out, duplicates, invalid records and outliers.

    ``canonical`` are the typed records as read; only their dates are looked at.
    Records of the period that are not in ``silver`` were duplicates.
    """
    zero = F.lit(0).cast("long")
    written = ("records_output", "invalid_records", "outliers")
    read = period_counts(canonical, start_date).select(
        "records_input", "records_kept", *[zero.alias(c) for c in written]
    )
    out = silver.agg(
        zero.alias("records_input"),
        zero.alias("records_kept"),
        F.count(F.lit(1)).alias("records_output"),
        F.count_if(~F.col("is_valid_record")).alias("invalid_records"),
        F.count_if(F.col("is_outlier")).alias("outliers"),
    )
    summed = read.unionByName(out).agg(*[F.sum(c).alias(c) for c in read.columns])
    return summed.select(
        "records_input",
        "records_output",
        (F.col("records_kept") - F.col("records_output")).alias("duplicates_removed"),
        "invalid_records",
        "outliers",
    )


def require_mart_columns(df: DataFrame) -> None:
    missing = [c for c in REQUIRED_FOR_MARTS if c not in df.columns]
    if missing:
        raise SchemaError(f"columns missing for the marts: {', '.join(missing)}")


def mart_types(df: DataFrame) -> DataFrame:
    """Date, price and quantity as typed columns; unreadable values become null."""
    require_mart_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            "data_compra": F.col("data_compra").try_cast("timestamp"),
            "preco_normalizado": plain_number(F.col("preco_normalizado"), types["preco_normalizado"]),
            "quantidade": plain_number(F.col("quantidade"), types["quantidade"]),
        }
    )


def is_eligible(df: DataFrame) -> Column:
    """Whether a record counts in the marts, outliers aside."""
    rule = (
        F.col("codigo_item_catalogo").isNotNull()
        & F.col("data_compra").isNotNull()
        & _positive("preco_normalizado")
        & _positive("quantidade")
    )
    if "is_valid_record" in df.columns:
        rule = rule & F.coalesce("is_valid_record", F.lit(False))
    return rule


def is_excluded_outlier(df: DataFrame, exclude_outliers: bool = True) -> Column:
    if exclude_outliers and "is_outlier" in df.columns:
        return F.coalesce("is_outlier", F.lit(False))
    return F.lit(False)


def eligible_records(df: DataFrame, exclude_outliers: bool = True) -> DataFrame:
    """The records the marts are built from."""
    typed = mart_types(df)
    return typed.filter(is_eligible(typed)).filter(~is_excluded_outlier(typed, exclude_outliers))


def preparation_metrics(df: DataFrame, exclude_outliers: bool = True) -> DataFrame:
    """One row: input, valid after and invalid before outlier removal, outliers."""
    typed = mart_types(df)
    ok, outlier = is_eligible(typed), is_excluded_outlier(typed, exclude_outliers)
    return typed.agg(
        F.count(F.lit(1)).alias("records_input"),
        F.count_if(ok & ~outlier).alias("records_valid"),
        F.count_if(~ok).alias("records_invalid"),
        F.count_if(ok & outlier).alias("records_outlier_excluded"),
    )


def mart_checks(mart: DataFrame) -> DataFrame:
    """One row of counts; every one but ``records`` must be zero."""
    return mart.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("preco_mediano") < 0).alias("negative_median_prices"),
        F.count_if(F.col("quantidade_compras") < 1).alias("invalid_purchase_counts"),
        F.count_if(F.col("codigo_item_catalogo").isNull()).alias("null_catmat"),
        F.count_if(F.col("ano_mes").isNull()).alias("null_period"),
    )


def require_valid_mart(table: str, checks: Mapping[str, int]) -> None:
    """Raise for an empty mart or any failed check."""
    if not checks["records"]:
        raise DataQualityError(f"table {table} is empty")
    if any(n for name, n in checks.items() if name != "records"):
        raise DataQualityError(f"quality failure in {table}: {dict(checks)}")


def silver_checks(silver: DataFrame) -> DataFrame:
    """One row: missing descriptions and technical keys used more than once."""
    keys = [k for k in TECHNICAL_KEY if k in silver.columns]
    repeated = (
        silver.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.sum("n").alias("records"),
            F.count_if(F.col("n") > 1).alias("duplicate_technical_keys"),
        )
        .withColumn("null_descriptions", F.lit(0).cast("long"))
    )
    missing = silver.agg(
        F.lit(0).cast("long").alias("records"),
        F.lit(0).cast("long").alias("duplicate_technical_keys"),
        F.count_if(F.col("descricao_item").isNull()).alias("null_descriptions"),
    )
    both = repeated.unionByName(missing)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in repeated.columns])


def mart_reference_checks(mart: DataFrame, materials: DataFrame, start_year: int) -> DataFrame:
    """One row: rows before the start year and rows without a known material."""
    known = materials.select("material_id").distinct()
    per_material = mart.groupBy("material_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("ano") < start_year).alias("early"),
    )
    unknown = per_material.join(known, "material_id", "left_anti")
    zero = F.lit(0).cast("long")
    parts = per_material.select("n", "early", zero.alias("unknown")).unionByName(
        unknown.select(zero.alias("n"), zero.alias("early"), F.col("n").alias("unknown"))
    )
    return parts.agg(
        F.coalesce(F.sum("n"), zero).alias("records"),
        F.coalesce(F.sum("early"), zero).alias("years_before_start"),
        F.coalesce(F.sum("unknown"), zero).alias("invalid_material_ids"),
    )
