"""Material catalogue: entries, mapping table, enrichment."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..fixed_values import CATALOGUE_COLUMNS
from ..functions.scalars import catalogue_code
from .joins import attach_dimension, bounded_size

# Catalogue entry as read, under either language's names.
ENTRY_SCHEMA = T.StructType(
    [
        T.StructField("position", T.LongType()),
        T.StructField("material_id", T.StringType()),
        T.StructField("nome", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("categoria", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("catmat", T.StringType()),
        T.StructField("codigo_catmat", T.StringType()),
        T.StructField("codigoItemCatalogo", T.StringType()),
        T.StructField("unidade_padrao", T.StringType()),
        T.StructField("standard_unit", T.StringType()),
        T.StructField("ativo", T.BooleanType()),
        T.StructField("active", T.BooleanType()),
    ]
)


def _text(value: Any) -> str | None:
    return None if value is None else str(value)


def catalogue_entries(spark: SparkSession, entries: Iterable[Mapping[str, Any]]) -> DataFrame:
    """The catalogue list as a table; ``position`` keeps its order."""
    rows = []
    for position, entry in enumerate(entries):
        row = {"position": position}
        for field in ENTRY_SCHEMA.fields[1:]:
            value = entry.get(field.name)
            if not isinstance(field.dataType, T.BooleanType):
                row[field.name] = _text(value)
            elif field.name in entry:  # present but empty means not in use
                row[field.name] = bool(value)
        rows.append(row)
    return spark.createDataFrame(rows, ENTRY_SCHEMA)


def active_entries(entries: DataFrame) -> DataFrame:
    """Entries in use: ``ativo``, else ``active``, else in use."""
    return entries.filter(F.coalesce("ativo", "active", F.lit(True)))


def _filled(*names: str):
    """First of the columns that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names])


def with_code(entries: DataFrame) -> DataFrame:
    """Entries that can be loaded, with their code in ``codigo_item_catalogo``."""
    code = _filled("catmat", "codigo_catmat", "codigoItemCatalogo")
    coded = entries.withColumn("codigo_item_catalogo", catalogue_code(code, T.StringType()))
    return coded.filter(code.isNotNull())


def catalogue_mapping(entries: DataFrame) -> DataFrame:
    """One row per code of the active entries; the last entry of a code wins."""
    coded = with_code(active_entries(entries))
    code = F.col("codigo_item_catalogo")
    named = coded.select(
        "position",
        code,
        F.coalesce("material_id", code).alias("material_id"),
        F.coalesce(_filled("nome", "name"), code).alias("material"),
        _filled("categoria", "category").alias("categoria_material"),
        _filled("unidade_padrao", "standard_unit").alias("unidade_padrao"),
    )
    last = Window.partitionBy("codigo_item_catalogo").orderBy(F.col("position").desc())
    return (
        named.withColumn("__rank", F.row_number().over(last))
        .filter("__rank = 1")
        .drop("__rank", "position")
    )


def enrich(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add the catalogue columns by code.

    With an empty catalogue the code and the description stand in for the
    material; with any other, unknown codes get nulls.
    """
    bare = df.drop(*CATALOGUE_COLUMNS)
    size = bounded_size(mapping)
    if not size:
        return bare.withColumns(
            {
                "material_id": F.col("codigo_item_catalogo"),
                "material": F.col("descricao_item"),
                "categoria_material": F.lit(None).cast("string"),
                "unidade_padrao": F.lit(None).cast("string"),
            }
        )
    return attach_dimension(bare, mapping, "codigo_item_catalogo", size)
