"""Parquet tables of the three layers.

Partition values are text and stay text: type inference would turn the code
``00456`` into a number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..operators.joins import BROADCAST_ROWS, bounded_size
from ..settings import SchemaError
from ..staging import delete_path, move_path, path_exists, shuffles_deleted, stage
from .evolving import fits, read_by_schema

BRONZE_PARTITIONS = ("catmat", "ano_ingestao", "mes_ingestao", "dia_ingestao")
SILVER_PARTITIONS = ("catmat", "ano", "mes")
_SORTED = ("data_compra",)
_COLUMNS = "_columns"
RUN_PARTITION = "of_run"
PAGE_KEY = ["_pipeline_run_id", "_catmat", "_page"]
_CANNOT_MERGE = "CANNOT_MERGE_SCHEMAS"
_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"
_LEAST_SIZE = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def read_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    base: str | None = None,
    object_column: str | None = None,
) -> DataFrame:
    """Parquet below a root, or the named files, by column name.

    Files may have different columns; absent ones are null. Columns whose type differs
    between files get the least type that holds all values (``sources.evolving``).
    ``object_column`` names a column for the file each row came from.
    """
    names = [paths] if isinstance(paths, str) else list(paths)
    if not names:
        raise SchemaError("no Parquet files were named")
    root = base or (paths if isinstance(paths, str) else None)

    def reader(merge: bool = False):
        made = spark.read.option("mergeSchema", merge).option("pathGlobFilter", "*.parquet")
        return made.option("basePath", root) if root else made

    def with_object(df: DataFrame) -> DataFrame:
        if object_column is None:
            return df
        return df.select("*", F.col("_metadata.file_path").alias(object_column))

    before = spark.conf.get(_INFERENCE)
    spark.conf.set(_INFERENCE, "false")
    try:
        try:
            return with_object(reader(merge=True).parquet(*names))
        except (PySparkException, Py4JJavaError) as error:  # a job's error comes as either
            if _CANNOT_MERGE not in str(error):
                raise
        listed = reader().schema("_ boolean").parquet(*names)
        return read_by_schema(spark, listed, reader, with_object)
    finally:
        spark.conf.set(_INFERENCE, before)


def spread(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Bring a partition's rows together, but split one that is too large.

    AQE sizes the result: small partitions share a task, a hot one gets several
    tasks and files.
    """
    return df.hint("rebalance", *[F.col(p) for p in partitions])


@contextmanager
def many_writers(spark: SparkSession) -> Iterator[None]:
    """While a partitioned table is written: small partitions share a task only as far
    as no core is idle, as opening hundreds of files takes longer than their few rows.
    The number of files stays the same."""
    before = spark.conf.get(_LEAST_SIZE)
    spark.conf.set(_LEAST_SIZE, "1b")
    try:
        with shuffles_deleted(spark):
            yield
    finally:
        spark.conf.set(_LEAST_SIZE, before)


def write_bronze(records: DataFrame, path: str) -> None:
    """Append records by code and day of ingestion; type, run and page are columns."""
    day = F.to_timestamp("_ingestion_timestamp")
    if "catmat" in records.columns:
        records = records.withColumnRenamed("catmat", "catmat_origem")
    parts = records.withColumns(
        {
            "catmat": F.col("_catmat"),
            "ano_ingestao": F.date_format(day, "yyyy"),
            "mes_ingestao": F.date_format(day, "MM"),
            "dia_ingestao": F.date_format(day, "dd"),
        }
    )
    laid = spread(parts, BRONZE_PARTITIONS).write.mode("append").option("compression", "snappy")
    with many_writers(records.sparkSession):
        laid.partitionBy(*BRONZE_PARTITIONS).parquet(path)


def unwritten(records: DataFrame, path: str) -> DataFrame:
    """The Bronze records that the table does not hold yet.

    A page of a run and code is written once: a run that is loaded again adds nothing
    for pages it has, and pages that a broken write has left in part are completed
    record by record, by hash and number of the copy. Only partitions of the records'
    codes are read, and of these the columns of the page's key; whole rows of the table
    are never compared. Pages without a run or number always count as new.
    """
    spark = records.sparkSession
    if not path_exists(spark, path):
        return records
    loaded = stage(records.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("loaded")), "loaded-pages")
    codes = loaded.select(F.col("_catmat").alias("catmat")).distinct()
    few = bounded_size(codes) <= BROADCAST_ROWS
    rows = read_parquet(spark, path).join(F.broadcast(codes) if few else codes, "catmat", "left_semi")
    runs = loaded.select("_pipeline_run_id").distinct()
    rows = rows.join(F.broadcast(runs) if bounded_size(runs) <= BROADCAST_ROWS else runs, "_pipeline_run_id", "left_semi")
    # A hash is missing from a table whose loads have all been empty of it.
    own_hash = F.col("_record_hash") if "_record_hash" in rows.columns else F.lit(None).cast("string")
    held = stage(rows.select(*PAGE_KEY, own_hash.alias("_record_hash")), "held-records")
    if held.isEmpty():
        return records
    pages = stage(loaded.join(held.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("held")), PAGE_KEY), "held-pages")
    fresh = records.join(pages, PAGE_KEY, "left_anti")
    broken = pages.filter("held < loaded")
    if broken.isEmpty():
        return fresh
    copy = F.row_number().over(Window.partitionBy(*PAGE_KEY, "_record_hash").orderBy(F.lit(1)))
    missing = records.join(broken, PAGE_KEY, "left_semi").withColumn("__copy", copy)
    there = held.join(broken, PAGE_KEY, "left_semi").withColumn("__copy", copy)
    same = [missing[c].eqNullSafe(there[c]) for c in (*PAGE_KEY, "_record_hash", "__copy")]
    missing = missing.join(there, reduce(lambda a, b: a & b, same), "left_anti").drop("__copy")
    return fresh.unionByName(missing.select(*fresh.columns))


def read_bronze(
    spark: SparkSession,
    paths: str | Sequence[str],
    base: str | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Bronze records with ``_bronze_object``, the file each one came from. ``codes``
    (``catmat``, distinct) are those whose partitions are read; few of them prune files."""
    read = read_parquet(spark, paths, base, "_bronze_object")
    if codes is not None:
        read = read.join(F.broadcast(codes) if bounded_size(codes) <= BROADCAST_ROWS else codes, "catmat", "left_semi")
    return read.drop("ano_ingestao", "mes_ingestao", "dia_ingestao", "catmat")


def silver_layout(silver: DataFrame) -> DataFrame:
    """Silver rows with partition columns; rows without one are left out."""
    renamed = silver
    if "catmat" in silver.columns:
        renamed = silver.withColumnRenamed("catmat", "catmat_origem")
    keyed = renamed.filter("codigo_item_catalogo IS NOT NULL AND ano IS NOT NULL AND mes IS NOT NULL")
    return keyed.withColumns(
        {
            "catmat": F.col("codigo_item_catalogo"),
            "ano": F.lpad(F.col("ano").cast("string"), 4, "0"),
            "mes": F.lpad(F.col("mes").cast("string"), 2, "0"),
        }
    )


def write_silver(silver: DataFrame, path: str, whole: bool = False) -> None:
    """Replace the partitions (code, year, month) that ``silver`` has rows for, or
    the ``whole`` table. The table's columns are noted beside it, so that reading it
    need not open its files."""
    laid = silver_layout(silver)
    fresh = whole or not path_exists(silver.sparkSession, path)
    if not fresh:  # before the rows: a column that no file has yet is null
        _note_columns(laid, path, fresh)
    order = [*SILVER_PARTITIONS, *[F.col(c).asc_nulls_last() for c in _SORTED if c in silver.columns]]
    with many_writers(silver.sparkSession):
        (
            spread(laid, SILVER_PARTITIONS)
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if whole else "dynamic")
            .option("compression", "snappy")
            .partitionBy(*SILVER_PARTITIONS)
            .parquet(path)
        )
    if fresh:
        _note_columns(laid, path, fresh)


def _note_columns(laid: DataFrame, path: str, fresh: bool) -> None:
    """Note a table's columns, or add to them. Without a note, or with a column that has
    changed its type, the files themselves are asked again (``read_parquet``)."""
    spark, note = laid.sparkSession, f"{path.rstrip('/')}/{_COLUMNS}"
    if not fresh and not path_exists(spark, note):
        return
    new = {f.name: f.dataType for f in laid.schema.fields if f.name not in SILVER_PARTITIONS}
    known = {} if fresh else {f.name: f.dataType for f in spark.read.parquet(note).schema.fields}
    if not fits(new, known):
        delete_path(spark, note)
    elif set(new) - set(known):
        fields = [T.StructField(name, kind) for name, kind in (known | new).items()]
        spark.createDataFrame([], T.StructType(fields)).write.mode("overwrite").parquet(note)


def replace_silver(silver: DataFrame, path: str) -> None:
    """Replace the whole table: written aside first and then moved into its place, so
    that a failure while writing leaves the table as it was. Should a run break between
    the two moves, the next call puts the table that was there back first."""
    spark = silver.sparkSession
    place = path.rstrip("/")
    aside, before = f"{place}__new", f"{place}__old"
    if path_exists(spark, before) and not path_exists(spark, place):
        move_path(spark, before, place)
    for leftover in (aside, before):
        delete_path(spark, leftover)
    write_silver(silver, aside, whole=True)
    if path_exists(spark, place):
        move_path(spark, place, before)
    move_path(spark, aside, place)
    delete_path(spark, before)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """All Silver rows; a path without data is an error.

    ``catmat``, ``ano`` and ``mes`` come from the path, so filters on them skip
    whole partitions; year and month are numbers again.
    """
    if not path_exists(spark, path):
        raise SchemaError(f"no Silver data below {path}")
    note = f"{path.rstrip('/')}/{_COLUMNS}"
    if path_exists(spark, note):
        kinds = T.StructType([*spark.read.parquet(note).schema.fields, *[T.StructField(c, T.StringType()) for c in SILVER_PARTITIONS]])
        read = spark.read.schema(kinds).option("pathGlobFilter", "*.parquet").parquet(path)
    else:
        read = read_parquet(spark, path)
    return read.withColumns({"ano": F.col("ano").cast("int"), "mes": F.col("mes").cast("int")})


def partition_columns(df: DataFrame) -> DataFrame:
    """The Silver partition of each record that has one."""
    return silver_layout(df).select(
        "catmat", *[F.col(c).cast("int").alias(c) for c in SILVER_PARTITIONS[1:]]
    )


def in_partitions(df: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows in some partitions; broadcast lets Spark prune files."""
    few = bounded_size(touched) <= BROADCAST_ROWS
    return df.join(F.broadcast(touched) if few else touched, list(SILVER_PARTITIONS), "left_semi")


def drop_emptied(spark: SparkSession, path: str, touched: DataFrame, left: DataFrame) -> None:
    """Delete the touched partitions that no row of ``left`` (partition columns) is in."""
    emptied = touched.join(left.distinct(), list(SILVER_PARTITIONS), "left_anti")
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in emptied.toLocalIterator():
        folder = f"catmat={escape(row['catmat'])}/ano={row['ano']:04d}/mes={row['mes']:02d}"
        delete_path(spark, f"{path}/{folder}")


def write_codes(mart: DataFrame, path: str) -> None:
    """Replace the rows of the codes that ``mart`` has rows for."""
    laid = mart.withColumn("catmat", F.col("codigo_item_catalogo"))
    writer = spread(laid, ["catmat"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with many_writers(mart.sparkSession):
        writer.partitionBy("catmat").parquet(path)


def read_of_codes(spark: SparkSession, path: str) -> DataFrame:
    """A mart that ``write_codes`` has written."""
    return read_parquet(spark, path).drop("catmat")


def drop_codes(spark: SparkSession, path: str, codes: DataFrame, left: DataFrame) -> None:
    """Delete the rows of those of ``codes`` that ``left`` has no row of."""
    kept = left.select(F.col("codigo_item_catalogo").alias("catmat")).distinct()
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in codes.join(kept, "catmat", "left_anti").toLocalIterator():
        delete_path(spark, f"{path}/catmat={escape(row['catmat'])}")


def write_of_runs(rows: DataFrame, path: str, run: str = "run_id") -> None:
    """Replace what a table holds of the runs of ``rows``; other runs stay. The runs
    are partitions, and stay a text column of the files as well."""
    (
        rows.withColumn(RUN_PARTITION, F.col(run))
        .repartition(RUN_PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN_PARTITION)
        .parquet(path)
    )


def read_of_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path).drop(RUN_PARTITION)


def write_snapshot(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> bool:
    """Replace a mart, by year and month if asked; an empty one is not written."""
    if df.isEmpty():
        return False
    shaped = spread(df, partitions) if partitions else df
    writer = shaped.write.mode("overwrite").option("compression", "snappy")
    if partitions:
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", "static")
    with many_writers(df.sparkSession):
        writer.parquet(path)
    return True
