"""Queries over landed pages.

``events`` arrive as pages: one sequence per event type and user, one page per
thousand event numbers. Users skip pages, so sequences have real gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.names import snake_case_values
from ..operators.hashes import field_hash
from ..plans.results import all_results, failed_materials, run_summary
from ..sources.landed import (
    bronze_records,
    infer_record_schema,
    page_rows,
    rejected_pages,
    settled_pages,
    with_metadata,
)
from ..sources.manifest import manifest_objects
from ..sources.page_order import page_facts, page_gaps, page_status, sequence_results, stopped_pages
from .registry import query
from .source import table

PAGE_SIZE = 2
ENDPOINT = "/precos"
RECORD = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("centavos", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("props", T.StructType([T.StructField("k", T.LongType())])),
    ]
)

_PAGE = "CAST(1 + floor(event_id / 1000) AS INT)"
_CENTS = "CAST(round(value * 100) AS BIGINT)"
# Pages say how many there are in two of four envelopes.
_DECLARED = "CAST(3 + user_id % 10 AS INT)"


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in four envelopes; a few bodies are no JSON."""
    events = table(spark, sf_dir, "events").withColumns(
        {"page": F.expr(_PAGE), "centavos": F.expr(_CENTS)}
    )
    stamp = F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    record = F.concat(
        F.lit('{"ts":"'), stamp,
        F.lit('","event_id":'), F.col("event_id").cast("string"),
        F.lit(',"props":'), F.col("props"),
        F.lit(',"centavos":'), F.col("centavos").cast("string"),
        F.lit("}"),
    )
    # A page holds at most a thousand events, by its number.
    pages = events.groupBy("event_type", "user_id", "page").agg(
        F.array_join(F.array_sort(F.collect_list(record)), ",").alias("items")
    )
    items, declared = F.col("items"), F.expr(_DECLARED).cast("string")
    shape = F.col("page") % 4
    body = (
        F.when(F.expr("user_id % 50 = 7 AND page = 3"), F.lit("oops"))
        .when(shape == 0, F.concat(F.lit('{"resultado":['), items, F.lit('],"totalPaginas":"'), declared, F.lit('"}')))
        .when(shape == 1, F.concat(F.lit('{"data":{"items":['), items, F.lit(']},"meta":{"pages":'), declared, F.lit("}}")))
        .when(shape == 2, F.concat(F.lit("["), items, F.lit("]")))
        .otherwise(F.concat(F.lit('{"resultado":{"x":1.5,"y":{}},"registros":['), items, F.lit(",7]}")))
    )
    return pages.select(
        F.concat(F.lit("run-"), "event_type").alias("run_id"),
        F.col("user_id").cast("string").alias("catmat"),
        F.lit("full").alias("extract_type"),
        "page",
        F.lit(ENDPOINT).alias("endpoint"),
        body.alias("body"),
    )


_EVENTS = (
    f"SELECT *, {_PAGE} AS page, {_CENTS} AS centavos, {_DECLARED} AS total,"
    f" user_id % 50 = 7 AND {_PAGE} = 3 AS bad FROM events"
)
_FACTS = (
    f"WITH e AS ({_EVENTS}), facts AS (SELECT concat('run-', event_type) AS run_id,"
    " CAST(user_id AS VARCHAR) AS catmat, page, count(*) AS records,"
    " any_value(CASE WHEN page % 4 IN (0, 1) THEN total END) AS declared_pages"
    " FROM e WHERE NOT bad GROUP BY ALL)"
)
_STATUS = (
    _FACTS
    + """, lasts AS (SELECT run_id, catmat, max(page) AS last FROM facts GROUP BY ALL),
    grid AS (SELECT run_id, catmat, unnest(range(1, last + 1)) AS page FROM lasts),
    g AS (SELECT grid.run_id, grid.catmat, CAST(grid.page AS INT) AS page, records, declared_pages,
      coalesce(grid.page >= declared_pages, false)
        OR (declared_pages IS NULL AND records < 2) AS ends
      FROM grid LEFT JOIN facts USING (run_id, catmat, page)),
    b AS (SELECT *,
      min(CASE WHEN ends AND records IS NOT NULL THEN page END) OVER w AS stop_page,
      min(CASE WHEN records IS NULL THEN page END) OVER w AS first_missing
      FROM g WINDOW w AS (PARTITION BY run_id, catmat)),
    status AS (SELECT run_id, catmat, page, records, declared_pages, ends,
      CASE WHEN records IS NULL THEN 'missing'
           WHEN page > first_missing THEN 'after_gap'
           WHEN page > stop_page THEN 'past_stop' ELSE 'accepted' END AS status FROM b)"""
)


@query(
    "landed_page_counts",
    _FACTS + " SELECT run_id, catmat, page, records, declared_pages FROM facts",
)
def landed_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_facts(settled_pages(landed_pages(spark, sf_dir)))


@query(
    "rejected_pages",
    f"WITH e AS ({_EVENTS}) SELECT DISTINCT concat('run-', event_type) AS run_id,"
    " CAST(user_id AS VARCHAR) AS catmat, page, 'NOT_JSON' AS reject_reason FROM e WHERE bad",
)
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rejected_pages(landed_pages(spark, sf_dir))
    return found.select("run_id", "catmat", "page", "reject_reason")


@query(
    "page_status",
    _STATUS + " SELECT run_id, catmat, page, records, declared_pages, status FROM status",
)
def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_status(page_facts(settled_pages(landed_pages(spark, sf_dir))), PAGE_SIZE)


@query(
    "page_sequences",
    _STATUS
    + """ SELECT run_id, catmat, count(*) FILTER (WHERE status = 'accepted') AS pages_accepted,
    CAST(coalesce(sum(records) FILTER (status = 'accepted'), 0) AS BIGINT) AS records_accepted,
    count(*) FILTER (WHERE status = 'missing') AS pages_missing,
    coalesce(bool_or(ends AND status = 'accepted'), false) AS complete FROM status GROUP BY ALL""",
)
def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence_results(page_facts(settled_pages(landed_pages(spark, sf_dir))), PAGE_SIZE)


@query(
    "page_gaps",
    _FACTS
    + """, l AS (SELECT run_id, catmat, page, lag(page, 1, 0) OVER (PARTITION BY run_id, catmat ORDER BY page) AS before FROM facts)
    SELECT run_id, catmat, CAST(before + 1 AS BIGINT) AS page, CAST(page - 1 AS BIGINT) AS last_page FROM l WHERE page > before + 1""",
)
def missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_gaps(page_facts(settled_pages(landed_pages(spark, sf_dir))))


@query(
    "stopped_records",
    _FACTS
    + """, s AS (SELECT run_id, catmat, min(page) FILTER (coalesce(page >= declared_pages, false)
      OR (declared_pages IS NULL AND records < 2)) AS stop FROM facts GROUP BY ALL)
    SELECT event_id, run_id AS _pipeline_run_id, catmat AS _catmat, page AS _page FROM e
    JOIN s ON s.run_id = concat('run-', event_type) AND s.catmat = CAST(user_id AS VARCHAR)
    WHERE NOT bad AND (stop IS NULL OR page <= stop)""",
)
def stopped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the pages up to the stop of their sequence."""
    pages = stopped_pages(settled_pages(landed_pages(spark, sf_dir)), PAGE_SIZE)
    return bronze_records(pages, RECORD).select("event_id", "_pipeline_run_id", "_catmat", "_page")


@query(
    "bronze_records",
    f"""WITH e AS ({_EVENTS}) SELECT event_id, centavos,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts,
    CAST(json_extract(props, '$.k') AS BIGINT) AS props__k, 'compras.gov.br' AS _source,
    '{ENDPOINT}' AS _source_endpoint, concat('run-', event_type) AS _pipeline_run_id,
    'FULL' AS _extract_type, page AS _page, CAST(user_id AS VARCHAR) AS _catmat,
    sha256(concat('{{"centavos":', centavos, ',"event_id":', event_id,
      ',"props":{{"k":', json_extract(props, '$.k'), '}},"ts":"',
      strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '"}}')) AS _record_hash
    FROM e WHERE NOT bad""",
)
def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = bronze_records(landed_pages(spark, sf_dir), RECORD)
    return records.drop("_ingestion_timestamp")


@query(
    "record_schema",
    f"""WITH e AS ({_EVENTS}) SELECT count(*) AS records,
    'centavos,event_id,props,ts' AS fields FROM e WHERE NOT bad""",
)
def record_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields found in the records themselves, without a given schema."""
    rows = page_rows(landed_pages(spark, sf_dir))
    fields = ",".join(infer_record_schema(rows).fieldNames())
    return rows.agg(F.count(F.lit(1)).alias("records"), F.lit(fields).alias("fields"))


_RESULTS = (
    f"WITH e AS ({_EVENTS}), results AS (SELECT concat('run-', event_type) AS run_id,"
    " CAST(user_id AS VARCHAR) AS catmat, 'FULL' AS extract_type,"
    " CASE WHEN bool_or(bad) THEN 'FAILED' ELSE 'SUCCESS' END AS status,"
    " count(DISTINCT page) FILTER (NOT bad) AS pages_processed,"
    " count(*) FILTER (NOT bad) AS records_written,"
    " CASE WHEN bool_or(bad) THEN 'NOT_JSON' END AS error FROM e GROUP BY ALL)"
)


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = landed_pages(spark, sf_dir)
    return all_results(with_metadata(page_rows(pages)).drop("record"), rejected_pages(pages))


@query("extract_results", _RESULTS + " SELECT * FROM results")
def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir).drop("started_at", "finished_at", "duration_seconds")


@query(
    "run_summary",
    _RESULTS
    + """ SELECT count(*) AS materials_processed, count(*) FILTER (WHERE status = 'SUCCESS') AS materials_success,
    count(*) FILTER (WHERE status = 'FAILED') AS materials_failed,
    CAST(sum(pages_processed) AS BIGINT) AS pages_processed,
    CAST(sum(records_written) AS BIGINT) AS records_written,
    CASE WHEN count(*) FILTER (WHERE status = 'FAILED') = 0 THEN 'SUCCESS' ELSE 'PARTIAL_SUCCESS' END AS status
    FROM results""",
)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(_results(spark, sf_dir))


@query(
    "failed_materials",
    _RESULTS + " SELECT run_id, catmat, extract_type, error FROM results WHERE status = 'FAILED'",
)
def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_materials(_results(spark, sf_dir))


@query(
    "manifest_objects",
    """WITH o AS (SELECT o_orderpriority AS run_id, o_orderstatus, concat('obj-', o_custkey) AS object_name,
      o_orderkey FROM orders)
    SELECT run_id, o_orderkey, object_name, 0 AS position FROM o
    UNION ALL SELECT run_id, o_orderkey, concat(object_name, '-b'), 1 FROM o
    UNION ALL SELECT run_id, o_orderkey, concat('st-', o_orderstatus), 3 FROM o""",
)
def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest per order, with names as text, as objects and in nested results."""
    orders = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("obj-"), F.col("o_custkey").cast("string"))
    manifest = F.concat(
        F.lit('{"status":"SUCCESS","objects":["'), name, F.lit('",{"object_name":"'), name,
        F.lit('-b"},5],"results":[{"objects":["'), name, F.lit('","st-'), F.col("o_orderstatus"),
        F.lit('"]},7]}'),
    )
    rows = orders.select(F.col("o_orderpriority").alias("run_id"), "o_orderkey", manifest.alias("manifest"))
    return manifest_objects(rows)


@query(
    "snake_case_names",
    """WITH n AS (SELECT DISTINCT concat(' _valor', o_orderpriority, 'OfOrder', o_orderstatus, ' ')
      AS source_name FROM orders)
    SELECT source_name, concat('_', lower(trim(regexp_replace(
      regexp_replace(trim(source_name), '([a-z0-9])([A-Z])', '\\1_\\2', 'g'),
      '[^a-zA-Z0-9]+', '_', 'g'), '_'))) AS snake_name FROM n""",
)
def snake_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names made of an order's priority and status."""
    name = F.concat(F.lit(" _valor"), "o_orderpriority", F.lit("OfOrder"), "o_orderstatus", F.lit(" "))
    names = table(spark, sf_dir, "orders").select(name.alias("source_name")).distinct()
    return names.withColumn("snake_name", snake_case_values(F.col("source_name")))


@query(
    "field_hash",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sha256(concat(l_orderkey, '|', l_linenumber, '|',
      CASE WHEN l_orderkey % 43 = 0 THEN '\\N' ELSE CAST(l_suppkey AS VARCHAR) END)) AS record_hash
    FROM lineitem""",
)
def hashed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn(
        "supplier", F.expr("CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE l_suppkey END")
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        field_hash(["l_orderkey", "l_linenumber", "supplier"]).alias("record_hash"),
    )
