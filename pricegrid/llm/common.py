"""Reading, registering and staging shared by the queries of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..staging import new_path, stage

_ROOT = str(Path(__file__).resolve().parents[2])

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, twin: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if twin is not None:
            TWINS[name] = twin
        return function

    return add


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, as the
    queries may be run without it being installed."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole given table."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write a table to the shared folder and go on from it."""
    if not options:
        return stage(df, name)
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only a key and a text, under fixed names; further columns, whatever their
    names, are not carried along."""
    importable(df.sparkSession)
    return df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
