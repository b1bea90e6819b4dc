"""Run parameters, errors and the session used by the jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


class DataQualityError(Exception):
    """A check that must stop the run has failed."""


class SchemaError(Exception):
    """The input's columns do not fit the operator."""


@dataclass(frozen=True)
class Settings:
    """Analytical parameters; the defaults are the published ones."""

    start_date: str = "2020-01-01"
    base_period: str = "2020-01"
    iqr_multiplier: float = 1.5
    min_outlier_group: int = 10
    exclude_outliers: bool = True
    shock_std: float = 2.0
    page_size: int = 500
    lookback_days: int = 30
    jdbc_batch: int = 1000


def require_utc(spark: SparkSession) -> None:
    """Raise unless dates are read and shown in UTC, as all results assume."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "+00:00", "Z"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC, not {zone}")


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the results rely on (UTC) and AQE on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
