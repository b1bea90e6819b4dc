"""The material catalogue, a YAML list kept next to the jobs."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators.catalogue import catalogue_entries
from ..settings import SchemaError

# Top-level keys of the list, the first non-empty one counts.
LIST_KEYS = ("materiais", "materials")


def read_catalogue(spark: SparkSession, path: str | Path) -> DataFrame:
    """All entries of the file, active or not, in file order."""
    import yaml

    with open(path, encoding="utf-8") as file:
        content = yaml.safe_load(file) or {}
    entries = next((content[k] for k in LIST_KEYS if content.get(k)), [])
    if not isinstance(entries, list):
        raise SchemaError(f"the catalogue must hold a list under {' or '.join(LIST_KEYS)}")
    return catalogue_entries(spark, entries)
