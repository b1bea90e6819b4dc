"""The registered queries, a few of them against their SQL twins."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import FLAGSHIP, entry, oracle_sql, queries
from compare import TABLES, normal

FOLDER = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert FLAGSHIP in queries()


@needs_tables
@pytest.mark.parametrize("name", ["bronze_records", "dedup_by_hash", "iqr_outliers", "since_watermark"])
def test_query_equals_its_twin(spark, name):
    db = duckdb.connect()
    db.sql("SET TimeZone = 'UTC'")
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = queries()[name](spark, str(FOLDER)).toPandas()
    assert len(got) and normal(got).equals(normal(db.sql(oracle_sql()[name]).df()))


@needs_tables
def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
