"""Silver as a table clustered by code and month.

The rows of a code and month are in one bucket, so limits per code and month, marts and
everything else that groups by these columns need no shuffle. That pays where the table
is read more often than written. One bucket is one task: a code and month must fit into
one, which the partitioned layout (``sources.tables``) does not ask for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..settings import SchemaError

CLUSTERED_BY = ("codigo_item_catalogo", "ano_mes")
# A bucket is shuffled to one task, at up to about 200 bytes a row and unevenly.
BUCKET_ROWS = 2_000_000


def bucket_count(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for a table of so many rows; a power of two, so that tables of different
    sizes can still be joined bucket by bucket."""
    return 1 << max(0, (max(1, rows) - 1).bit_length() - (bucket_rows - 1).bit_length())


def write_clustered(silver: DataFrame, table: str, buckets: int | None = None) -> None:
    """Replace a table of the catalogue by Silver rows in ``buckets`` files (by default
    as many as their number asks for), each sorted by code, month and date. Rows without
    a code or month are kept."""
    missing = [c for c in CLUSTERED_BY if c not in silver.columns]
    if missing:
        raise SchemaError(f"columns missing for clustering: {', '.join(missing)}")
    number = bucket_count(silver.count()) if buckets is None else buckets
    order = [*CLUSTERED_BY, *[c for c in ("data_compra",) if c in silver.columns]]
    (
        silver.repartition(number, *[F.col(c) for c in CLUSTERED_BY])
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(number, *CLUSTERED_BY)
        .sortBy(*order)
        .saveAsTable(table)
    )


def read_clustered(spark: SparkSession, table: str) -> DataFrame:
    if not spark.catalog.tableExists(table):
        raise SchemaError(f"no table {table}")
    return spark.table(table)
