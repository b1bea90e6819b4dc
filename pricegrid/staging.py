"""Written tables that cut a plan in two.

A staged table is Parquet in the folder that ``spark.checkpoint.dir`` names, so
it outlives lost executors and later reads prune its columns.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_FOLDER_CONF = "spark.checkpoint.dir"
_TIMESTAMP_TYPE = "spark.sql.parquet.outputTimestampType"
_DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folder: str | None = None
_unowned: list[str] = []
# Where the staged frames that are still held are written.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
# Of the running thread: a stream's batches have scopes of their own.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def stage_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local master."""
    folder = spark.conf.get(_FOLDER_CONF, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_FOLDER_CONF} to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="pricegrid-")
    return _local_folder


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder; the innermost scope owns it."""
    path = f"{stage_folder(spark).rstrip('/')}/pricegrid/{name}-{uuid.uuid4().hex}"
    (_scopes.get()[-1] if _scopes.get() else _unowned).append(path)
    return path


@atexit.register
def _delete_unowned() -> None:
    """Tables staged outside of a scope are read by frames that a caller holds, so they
    stay as long as the driver runs, and go with it if Spark still does."""
    spark = SparkSession.getActiveSession() if _unowned else None
    if spark is None:
        return
    for path in _unowned:
        try:
            delete_path(spark, path)
        except Exception:  # Spark is gone, and with it the way to the folder
            return


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """While tables are written or counted: an action's shuffle files go as soon as it is
    done, as nothing reads them again. Otherwise they wait for the driver's garbage
    collection."""
    before = spark.conf.get(_DELETE_SHUFFLES, "false")
    spark.conf.set(_DELETE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DELETE_SHUFFLES, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table. Its rows are read a few times
    and then deleted, so they are packed tighter than those of the layers, and timestamps
    are plain microseconds, which take less time to write and read than Spark's default."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_TIMESTAMP_TYPE)
    spark.conf.set(_TIMESTAMP_TYPE, "TIMESTAMP_MICROS")
    try:
        with shuffles_deleted(spark):
            df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_TIMESTAMP_TYPE, before)
    written = spark.read.schema(df.schema).parquet(path)
    _paths[written] = path
    return written


def unstage(written: DataFrame) -> None:
    """Delete a staged table before its scope ends. Neither the frame that ``stage`` has
    returned nor any made from it can be used afterwards."""
    path = _paths.pop(written, None)
    if path is not None:
        delete_path(written.sparkSession, path)


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside at the end of a run.

    Frames that read them cannot be used afterwards.
    """
    own: list[str] = []
    before = _scopes.set((*_scopes.get(), own))
    try:
        yield
    finally:
        _scopes.reset(before)
        for path in own:
            delete_path(spark, path)


def settled(df: DataFrame) -> DataFrame:
    """A one-row frame as plain values, free of the tables it was read from."""
    with shuffles_deleted(df.sparkSession):
        # The conf is read when a frame is planned, so the limit is planned here.
        return df.sparkSession.createDataFrame(df.take(1), df.schema)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename; raises when the file system refuses."""
    files, source = _file_system(spark, path)
    if not files.rename(source, _file_system(spark, target)[1]):
        raise OSError(f"cannot move {path} to {target}")
