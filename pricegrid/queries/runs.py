"""Queries over runs: watermarks, changes, merges, round trips and the stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..fixed_values import MONTHLY_DIMENSIONS, MONTHLY_SERIES, MONTHLY_TABLE
from ..operators.catalogue import catalogue_mapping, enrich
from ..operators.derive import derived_columns
from ..operators.marts import METRICS, monthly_mart
from ..operators.outliers import GROUP, PRICE
from ..operators.periods import within_period
from ..operators.quality import eligible_records, quality_flags
from ..operators.quantiles import group_quantiles
from ..plans.bronze import run_bronze
from ..plans.gold import refresh_gold, run_gold
from ..plans.incremental_load import Lake, incremental_load
from ..plans.incremental import (
    WATERMARK_SCHEMA,
    advance_watermarks,
    classify_changes,
    merge_silver,
    since_watermark,
)
from ..plans.price_counts import PriceCounts
from ..plans.results import audit_rows, layer_results
from ..plans.silver import run_silver
from ..settings import SchemaError
from ..sources.clustered import bucket_count, read_clustered, write_clustered
from ..sources.landed import bronze_records
from ..sources.tables import read_bronze, read_of_codes, read_of_runs, read_silver, write_bronze, write_silver
from ..staging import new_path, path_exists, stage
from ..streaming.completeness import EVENTS, start_completeness_stream
from ..streaming.pages import page_stream, start_silver_stream
from .landed import _STATUS, PAGE_SIZE, RECORD, landed_pages
from .marts import (
    _ELIGIBLE,
    MONTHLY_PRICES_SQL,
    MONTHLY_SQL,
    _mart_list,
    _series,
    _series_list,
    indicators_sql,
    mart_sql,
)
from .records import (
    IQR_SQL,
    SETTINGS,
    cleaned_purchases,
    flagged_purchases,
    flagged_sql,
    iqr_outliers,
)
from .registry import comparable, query
from .source import PURCHASE, START_DATE, entries, purchases, purchases_sql, table

# The control table, derived from the parts' brands: codes up to 20 were loaded up
# to a date of their own, the others never.
_MARK_DAYS = "CAST(codigo AS INT) * 60"
_MARKS_SQL = (
    "SELECT DISTINCT replace(p_brand, 'Brand#', '') AS codigo FROM part"
    " WHERE CAST(replace(p_brand, 'Brand#', '') AS INT) <= 20"
)
_LINE = ("id_compra", "id_item_compra", "codigo_item_catalogo", "data_compra", "arrival", "update_days")


def watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.expr("replace(p_brand, 'Brand#', '')")
    codes = table(spark, sf_dir, "part").select(code.alias("codigo")).distinct()
    mark = F.lit("1997-01-01").cast("timestamp") + F.make_dt_interval(F.expr(_MARK_DAYS))
    known = codes.filter("CAST(codigo AS INT) <= 20").select(
        F.concat(F.lit("M-"), "codigo").alias("material_id"),
        F.col("codigo").alias("codigo_catmat"),
        mark.alias("watermark"),
        mark.alias("ultima_data_compra"),
        mark.alias("ultima_data_ingestao"),
        F.lit("2002-01-01").cast("timestamp").alias("ultima_execucao"),
        F.lit("SUCCESS").alias("status"),
    )
    return known.select(*WATERMARK_SCHEMA.fieldNames())


def updated_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases(spark, sf_dir, _LINE)
    update = F.col("data_compra") + F.make_dt_interval(F.col("update_days").cast("int"))
    return rows.withColumn("data_hora_atualizacao_item", update)


_UPDATED_SQL = (
    f"p AS (SELECT *, data_compra + to_days(CAST(update_days AS INT)) AS changed"
    f" FROM ({purchases_sql(_LINE)})), w AS (SELECT codigo,"
    f" TIMESTAMP '1997-01-01' + to_days({_MARK_DAYS}) AS mark FROM ({_MARKS_SQL}))"
)


def _since_twin(days: int) -> str:
    return f"""WITH {_UPDATED_SQL} SELECT id_compra, id_item_compra, codigo_item_catalogo, arrival
    FROM p LEFT JOIN w ON codigo_item_catalogo = codigo
    WHERE mark IS NULL OR changed IS NULL OR changed >= mark - to_days({days})"""


@query("since_watermark", _since_twin(0))
def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = since_watermark(updated_purchases(spark, sf_dir), watermarks(spark, sf_dir))
    return rows.select("id_compra", "id_item_compra", "codigo_item_catalogo", "arrival")


@query("since_watermark_with_lookback", _since_twin(30))
def lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = since_watermark(
        updated_purchases(spark, sf_dir), watermarks(spark, sf_dir), lookback_days=30
    )
    return rows.select("id_compra", "id_item_compra", "codigo_item_catalogo", "arrival")




def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result per code; codes that end in 5 failed."""
    code = F.expr("replace(p_brand, 'Brand#', '')")
    codes = table(spark, sf_dir, "part").groupBy(code.alias("catmat")).agg(
        F.count(F.lit(1)).alias("pages_processed"), F.sum("p_size").alias("records_written")
    )
    failed = F.col("catmat").endswith("5")
    stamp = F.lit("2002-02-01").cast("timestamp")
    return codes.select(
        F.lit("run-1").alias("run_id"), "catmat", F.lit("INCREMENTAL").alias("extract_type"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        "pages_processed", "records_written", stamp.alias("started_at"),
        stamp.alias("finished_at"), F.lit(0.0).alias("duration_seconds"),
        F.when(failed, "NOT_JSON").alias("error"),
    )


def advanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = updated_purchases(spark, sf_dir).select(
        "*",
        F.concat(F.lit("M-"), "codigo_item_catalogo").alias("material_id"),
        F.lit("2002-02-01").cast("timestamp").alias("ingestion_timestamp"),
    )
    run_at = F.lit("2002-02-02").cast("timestamp")
    return advance_watermarks(
        watermarks(spark, sf_dir), rows, run_results(spark, sf_dir), run_at
    )


_ADVANCED_SQL = f"""{_UPDATED_SQL}, s AS (SELECT codigo_item_catalogo AS codigo,
      max(coalesce(changed, data_compra)) AS mark, max(data_compra) AS bought FROM p
      WHERE codigo_item_catalogo IS NOT NULL AND codigo_item_catalogo NOT LIKE '%5' GROUP BY ALL),
    a AS (SELECT 'M-' || coalesce(s.codigo, w.codigo) AS material_id,
      coalesce(s.codigo, w.codigo) AS codigo_catmat, greatest(s.mark, w.mark) AS watermark,
      w.mark AS watermark_before, greatest(s.bought, w.mark) AS ultima_data_compra,
      CASE WHEN s.codigo IS NULL THEN w.mark ELSE TIMESTAMP '2002-02-01' END AS ultima_data_ingestao,
      CASE WHEN s.codigo IS NULL THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2002-02-02' END
        AS ultima_execucao, 'SUCCESS' AS status FROM s FULL JOIN w ON s.codigo = w.codigo)"""


@query(
    "advance_watermarks",
    f"WITH {_ADVANCED_SQL} SELECT material_id, codigo_catmat, watermark, ultima_data_compra,"
    " ultima_data_ingestao, ultima_execucao, status FROM a",
)
def moved_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(advanced(spark, sf_dir))


# Purchases before 1999 are in the table; those from mid 1998 on come in, some
# of them again, and every line's later arrivals carry another hash.
_OLD, _NEW = "data_compra < TIMESTAMP '1999-01-01'", "data_compra >= TIMESTAMP '1998-07-01'"
_CHANGE = (*_LINE[:4], "arrival", "record_hash")


def _change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases(spark, sf_dir, tuple(dict.fromkeys(_CHANGE)))
    hashed = rows.withColumn("record_hash", F.expr("record_hash || '-' || CAST(arrival AS STRING)"))
    return stage(hashed, "change-rows")


_CHANGE_SQL = (
    f"p AS (SELECT * REPLACE (record_hash || '-' || CAST(arrival AS STRING) AS record_hash)"
    f" FROM ({purchases_sql(tuple(dict.fromkeys(_CHANGE)))})),"
    f" old AS (SELECT * FROM p WHERE {_OLD}), inc AS (SELECT * FROM p WHERE {_NEW}),"
    """ c AS (SELECT *, CASE
      WHEN record_hash IN (SELECT record_hash FROM old WHERE record_hash IS NOT NULL) THEN 'same'
      WHEN codigo_item_catalogo IS NOT NULL AND (id_compra, id_item_compra, codigo_item_catalogo) IN
        (SELECT (id_compra, id_item_compra, codigo_item_catalogo) FROM old
         WHERE codigo_item_catalogo IS NOT NULL) THEN 'updated'
      ELSE 'new' END AS change FROM inc)"""
)


@query(
    "classify_changes",
    f"WITH {_CHANGE_SQL} SELECT id_compra, id_item_compra, codigo_item_catalogo, arrival, record_hash,"
    " change FROM c",
)
def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _change_rows(spark, sf_dir)
    found = classify_changes(rows.filter(_NEW), rows.filter(_OLD))
    return found.drop("data_compra")


# What outlier limits and the audit read of a record.
_AUDITED = ("codigo_item_catalogo", "ano_mes", "material_id", "preco_normalizado", "is_valid_record")
_CHANGES_OF_CODES = _CHANGE_SQL.replace("p AS (SELECT", "pc AS (SELECT", 1).replace("FROM p WHERE", "FROM pc WHERE")


@query(
    "audit_table",
    f"""WITH {_ADVANCED_SQL}, {flagged_sql().replace('p AS', 'p0 AS', 1).replace('FROM p q', 'FROM p0 q')}, {IQR_SQL},
    {_CHANGES_OF_CODES},
    r AS (SELECT replace(p_brand, 'Brand#', '') AS catmat, count(*) AS pages,
      CAST(sum(p_size) AS BIGINT) AS records FROM part GROUP BY ALL),
    v1 AS (SELECT codigo_item_catalogo AS catmat, max(material_id) AS material_id,
      count(*) FILTER (WHERE NOT is_valid_record) AS registros_invalidos, count(*) FILTER (WHERE is_outlier) AS outliers
      FROM o GROUP BY ALL),
    k AS (SELECT codigo_item_catalogo AS catmat, count(*) FILTER (change = 'new') AS registros_novos,
      count(*) FILTER (change = 'updated') AS registros_atualizados, count(*) FILTER (change = 'same') AS registros_duplicados
      FROM c GROUP BY ALL)
    SELECT 'run-1' AS run_id, v1.material_id, r.catmat, TIMESTAMP '2002-02-01' AS inicio,
      TIMESTAMP '2002-02-01' AS fim, 0.0::DOUBLE AS duracao_segundos, pages AS paginas_consultadas,
      records AS registros_recebidos, registros_novos, registros_atualizados, registros_duplicados, registros_invalidos,
      outliers, w.mark AS watermark_anterior, a.watermark AS watermark_novo,
      CASE WHEN r.catmat LIKE '%5' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
      CASE WHEN r.catmat LIKE '%5' THEN 'NOT_JSON' END AS erro
    FROM r LEFT JOIN v1 ON r.catmat = v1.catmat LEFT JOIN k ON k.catmat = r.catmat LEFT JOIN w ON w.codigo = r.catmat
      LEFT JOIN a ON a.codigo_catmat = r.catmat""",
)
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = iqr_outliers(cleaned_purchases(spark, sf_dir, _AUDITED))
    rows = _change_rows(spark, sf_dir)
    change = classify_changes(rows.filter(_NEW), rows.filter(_OLD)).withColumnRenamed(
        "codigo_item_catalogo", "catmat"
    )
    return comparable(
        audit_rows(run_results(spark, sf_dir), silver, change, watermarks(spark, sf_dir), advanced(spark, sf_dir))
    )


def _merge_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (
        "id_compra", "id_item_compra", "tipo", "descricao_item", "unidade_original", "quantidade",
        "preco_unitario", "data_compra", "uf", "record_hash", "arrival",
    )
    rows = purchases(spark, sf_dir, columns).filter("data_compra IS NOT NULL")
    rows = rows.withColumnRenamed("tipo", "codigo_item_catalogo").withColumns(
        {
            "record_hash": F.expr("record_hash || '-' || CAST(arrival AS STRING)"),
            "ingestion_timestamp": F.timestamp_micros("arrival"),
        }
    )
    mapping = catalogue_mapping(entries(spark, sf_dir))
    return quality_flags(derived_columns(enrich(rows, mapping)))


_MERGED = ("id_compra", "id_item_compra", "codigo_item_catalogo", "record_hash", "ano_mes", "arrival")


@query(
    "merge_into_silver",
    f"""WITH p AS (SELECT * REPLACE (record_hash || '-' || CAST(arrival AS STRING) AS record_hash)
      FROM ({purchases_sql(('id_compra', 'id_item_compra', 'tipo', 'data_compra', 'record_hash', 'arrival'))})
      WHERE data_compra IS NOT NULL)
    SELECT id_compra, id_item_compra, tipo AS codigo_item_catalogo, record_hash,
      strftime(data_compra, '%Y-%m') AS ano_mes, arrival FROM p
    QUALIFY row_number() OVER (PARTITION BY id_compra, id_item_compra, tipo
      ORDER BY arrival DESC) = 1""",
)
def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after two batches, the second with newer versions of lines."""
    path = new_path(spark, "merged-silver")
    rows = stage(_merge_input(spark, sf_dir), "merge-input")
    merge_silver(spark, path, rows.filter(_OLD), SETTINGS, written=True)
    merge_silver(spark, path, rows.filter(_NEW), SETTINGS, written=True)
    return read_silver(spark, path).select(*_MERGED)


@query(
    "bronze_round_trip",
    """SELECT event_id, concat('run-', event_type) AS _pipeline_run_id,
    CAST(user_id AS VARCHAR) AS _catmat, CAST(1 + floor(event_id / 1000) AS INT) AS _page,
    true AS has_file FROM events
    WHERE NOT (user_id % 50 = 7 AND CAST(1 + floor(event_id / 1000) AS INT) = 3)""",
)
def bronze_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "bronze")
    stamp = F.lit("2024-03-05 06:07:08").cast("timestamp")
    write_bronze(bronze_records(landed_pages(spark, sf_dir), RECORD, stamp), path)
    read = read_bronze(spark, path)
    has_file = F.col("_bronze_object").contains("ano_ingestao=2024/mes_ingestao=03/dia_ingestao=05")
    return read.select(
        "event_id", "_pipeline_run_id", "_catmat", "_page", has_file.alias("has_file")
    )


@query(
    "silver_round_trip",
    f"""WITH {flagged_sql()} SELECT id_compra, id_item_compra, arrival, codigo_item_catalogo,
    codigo_item_catalogo AS catmat, ano, mes, data_compra, is_valid_record FROM f
    WHERE codigo_item_catalogo IS NOT NULL AND ano IS NOT NULL AND mes IS NOT NULL""",
)
def silver_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "silver")
    write_silver(flagged_purchases(spark, sf_dir), path)
    return comparable(
        read_silver(spark, path).select(
            "id_compra", "id_item_compra", "arrival", "codigo_item_catalogo", "catmat", "ano",
            "mes", "data_compra", "is_valid_record",
        )
    )


@query(
    "gold_round_trip",
    f"WITH {MONTHLY_PRICES_SQL} SELECT {_series_list(MONTHLY_DIMENSIONS)} FROM mi",
)
def gold_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written, marts rebuilt from it, snapshots replaced and read."""
    silver_path, gold_path = new_path(spark, "silver"), new_path(spark, "gold")
    write_silver(iqr_outliers(flagged_purchases(spark, sf_dir, staged=True)), silver_path)
    run_gold(spark, silver_path, gold_path, SETTINGS, partitions=("ano", "mes"))
    return _series(spark.read.parquet(f"{gold_path}/{MONTHLY_TABLE}"), MONTHLY_DIMENSIONS)


# Purchases as pages: one sequence per part type, one page per order.
@query(
    "silver_stream",
    f"""WITH p AS ({purchases_sql(('id_compra', 'id_item_compra', 'tipo', 'quantidade', 'data_compra'))})
    SELECT id_compra, id_item_compra, tipo AS codigo_item_catalogo,
      strftime(data_compra, '%Y-%m') AS ano_mes, round(quantidade, 4) + 0.0 AS quantidade
    FROM (SELECT DISTINCT * FROM p) WHERE data_compra >= TIMESTAMP '{START_DATE}'""",
)
def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to a folder, read as a stream and merged by micro-batches.

    Purchase lines are keyed by their quantity and date as well, so that every
    distinct record stays.
    """
    columns = ("id_compra", "id_item_compra", "tipo", "quantidade", "data_compra")
    rows = purchases(spark, sf_dir, columns)
    line = F.concat_ws("-", "id_item_compra", "quantidade", F.unix_date(F.to_date("data_compra")))
    record = F.to_json(
        F.struct(
            F.col("id_compra").alias("idCompra"),
            line.alias("idItemCompra"),
            F.col("quantidade"),
            F.date_format("data_compra", "yyyy-MM-dd").alias("dataCompra"),
            F.lit(1.5).alias("precoUnitario"),
        )
    )
    pages = rows.groupBy("tipo", "id_compra").agg(
        F.array_join(F.array_sort(F.collect_list(record)), ",").alias("items")
    )
    folder = new_path(spark, "landing")
    pages.select(
        F.lit("run-1").alias("run_id"),
        F.col("tipo").alias("catmat"),
        F.lit("INCREMENTAL").alias("extract_type"),
        F.col("id_compra").cast("int").alias("page"),
        F.lit("/precos").alias("endpoint"),
        F.concat(F.lit('{"resultado":['), "items", F.lit("]}")).alias("body"),
        F.lit("2024-01-01").cast("timestamp").alias("landed_at"),
    ).write.parquet(folder)
    silver_path = new_path(spark, "stream-silver")
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("idCompra", "idItemCompra", "dataCompra")]
        + [T.StructField(n, T.DoubleType()) for n in ("quantidade", "precoUnitario")]
    )
    stream_query = start_silver_stream(
        page_stream(spark, folder), schema, catalogue_mapping(entries(spark, sf_dir)),
        silver_path, new_path(spark, "stream-state"), SETTINGS,
    )
    stream_query.awaitTermination()
    item = F.substring_index("id_item_compra", "-", 1)
    return comparable(
        read_silver(spark, silver_path).select(
            "id_compra", item.alias("id_item_compra"), "codigo_item_catalogo", "ano_mes", "quantidade"
        )
    )


# Purchases as pages of two runs: orders that 3 divides are in both of them.
_RUN_COLUMNS = ("id_compra", "id_item_compra", "codigo_item_catalogo", "quantidade", "preco_unitario", "data_compra", "arrival")
# Loads that are written several times have the six part types for codes.
_TYPE_COLUMNS = tuple("tipo" if c == "codigo_item_catalogo" else c for c in _RUN_COLUMNS)
_TYPES_SQL = f"(SELECT * EXCLUDE (tipo), tipo AS codigo_item_catalogo FROM ({purchases_sql(_TYPE_COLUMNS)}))"


def _typed_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases(spark, sf_dir, _TYPE_COLUMNS).withColumnRenamed("tipo", "codigo_item_catalogo")


def _type_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with part types for codes."""
    name = F.concat(F.lit("T-"), "categoria")
    return entries(spark, sf_dir).withColumns({"catmat": F.col("categoria"), "material_id": name})
_RUNS = {"run-1": "CAST(id_compra AS BIGINT) % 2 = 0 OR CAST(id_compra AS BIGINT) % 3 = 0"}
_RUNS["run-2"] = "CAST(id_compra AS BIGINT) % 2 = 1 OR CAST(id_compra AS BIGINT) % 3 = 0"


def _run_pages(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    record = F.to_json(
        F.struct(
            F.col("id_compra").alias("idCompra"),
            F.concat_ws("-", "id_item_compra", "arrival", F.col("quantidade").cast("int")).alias("idItemCompra"),
            "quantidade",
            F.col("preco_unitario").alias("precoUnitario"),
            F.date_format("data_compra", "yyyy-MM-dd").alias("dataCompra"),
        )
    )
    rows = purchases(spark, sf_dir, _RUN_COLUMNS).filter(_RUNS[run])
    pages = rows.groupBy("codigo_item_catalogo", "id_compra").agg(
        F.array_join(F.array_sort(F.collect_list(record)), ",").alias("items")
    )
    return pages.select(
        F.lit(run).alias("run_id"),
        F.col("codigo_item_catalogo").alias("catmat"),
        F.lit("incremental").alias("extract_type"),
        F.col("id_compra").cast("int").alias("page"),
        F.lit("/precos").alias("endpoint"),
        F.concat(F.lit('{"dados":{"items":[]},"totalPaginas":99999999,"resultado":['), "items", F.lit("]}")).alias("body"),
    )


@query(
    "silver_load_two_runs",
    f"""SELECT DISTINCT id_compra, id_item_compra || '-' || arrival || '-' || CAST(quantidade AS INT) AS id_item_compra, codigo_item_catalogo,
      strftime(data_compra, '%Y-%m') AS ano_mes, round(quantidade, 4) + 0.0 AS quantidade,
      round(preco_unitario, 4) + 0.0 AS preco_unitario FROM ({purchases_sql(_RUN_COLUMNS)})
    WHERE data_compra >= TIMESTAMP '{START_DATE}' AND codigo_item_catalogo NOT IN ('24', '25')""",
)
def two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two Bronze loads without a given schema, each loaded into Silver by its own
    files; the second must keep what the first has brought."""
    bronze, silver = new_path(spark, "runs-bronze"), new_path(spark, "runs-silver")
    catalogue = entries(spark, sf_dir)
    mapping = catalogue_mapping(catalogue)
    for run in _RUNS:
        run_bronze(spark, _run_pages(spark, sf_dir, run), catalogue, bronze, new_path(spark, "runs-results"))
        of_run = read_bronze(spark, bronze).filter(F.col("_pipeline_run_id") == run)
        names = [x[0] for x in of_run.select("_bronze_object").distinct().collect()]
        run_silver(spark, bronze, silver, mapping, names, SETTINGS)
    return comparable(
        read_silver(spark, silver).select(
            "id_compra", "id_item_compra", "codigo_item_catalogo", "ano_mes", "quantidade", "preco_unitario"
        )
    )


# ---- loads that change, break and repeat

# How three loads send a price: as a number, as local text, and as true or false.
_KINDS = {"k-0": "CAST(id_compra AS BIGINT) % 3 = 0", "k-1": "CAST(id_compra AS BIGINT) % 3 = 1", "k-2": "CAST(id_compra AS BIGINT) % 3 = 2"}
_CENTS_TEXT = "replace(CAST(CAST(floor(preco_unitario * 100) AS BIGINT) AS STRING), '-', '')"


def _kind_pages(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """Pages of whole cents, as every load writes them in its own way; the second load
    nests the buyer and the third has no quantity."""
    cents = F.expr("CAST(floor(preco_unitario * 100) AS BIGINT)")
    price = {
        "k-0": F.concat(cents.cast("string"), F.lit("e-2")),
        "k-1": F.concat(F.lit('"'), (cents / 100).cast("decimal(20,2)").cast("string"), F.lit('"')),
        "k-2": F.lit("true"),
    }[run]
    if run == "k-1":
        price = F.translate(price, ".", ",")
    rest = {
        "k-0": F.concat(F.lit(',"quantidade":'), F.col("quantidade").cast("int").cast("string")),
        "k-1": F.concat(F.lit(',"quantidade":"'), F.col("quantidade").cast("int").cast("string"), F.lit('","orgao":{"codigo":"'), "id_compra", F.lit('"}')),
        "k-2": F.lit(',"orgao":[1]'),
    }[run]
    item = F.concat_ws("-", "id_item_compra", "arrival", F.col("quantidade").cast("int"))
    record = F.concat(
        F.lit('{"idCompra":"'), "id_compra", F.lit('","idItemCompra":"'), item, F.lit('","precoUnitario":'), price, rest,
        F.lit(',"dataCompra":"'), F.date_format("data_compra", "yyyy-MM-dd"), F.lit('"}'),
    )
    rows = _typed_purchases(spark, sf_dir).filter(_KINDS[run]).filter("data_compra IS NOT NULL")
    pages = rows.groupBy("codigo_item_catalogo", "id_compra").agg(F.array_join(F.array_sort(F.collect_list(record)), ",").alias("items"))
    return pages.select(
        F.lit(run).alias("run_id"), F.col("codigo_item_catalogo").alias("catmat"), F.lit("FULL").alias("extract_type"),
        F.col("id_compra").cast("int").alias("page"), F.lit("/precos").alias("endpoint"),
        F.concat(F.lit('{"totalPaginas":99999999,"resultado":['), "items", F.lit("]}")).alias("body"),
    )


@query(
    "changing_types",
    f"""WITH p AS (SELECT DISTINCT id_compra, id_item_compra || '-' || arrival || '-' || CAST(quantidade AS INT) AS id_item_compra,
      codigo_item_catalogo, CAST(id_compra AS BIGINT) % 3 AS k, floor(preco_unitario * 100) / 100 AS price, CAST(quantidade AS INT) AS q
      FROM {_TYPES_SQL} WHERE data_compra >= TIMESTAMP '{START_DATE}')
    SELECT id_compra, id_item_compra, codigo_item_catalogo, 'k-' || k AS pipeline_run_id,
      CASE WHEN k < 2 THEN round(price, 4) + 0.0 END AS preco_unitario, CASE WHEN k < 2 THEN q + 0.0::DOUBLE END AS quantidade,
      k = 1 AS nested, k = 2 AS listed FROM p""",
)
def changing_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads whose price is a number, local text and a boolean, whose buyer is
    absent, nested and a list, read as one and loaded into Silver together."""
    bronze, silver = new_path(spark, "kinds-bronze"), new_path(spark, "kinds-silver")
    catalogue = _type_entries(spark, sf_dir)
    for run in _KINDS:
        run_bronze(spark, _kind_pages(spark, sf_dir, run), catalogue, bronze, new_path(spark, "kinds-results"))
    run_silver(spark, bronze, silver, catalogue_mapping(catalogue), settings=SETTINGS)
    return comparable(
        read_silver(spark, silver).select(
            "id_compra", "id_item_compra", "codigo_item_catalogo", "pipeline_run_id", "preco_unitario", "quantidade",
            F.col("orgao_codigo").isNotNull().alias("nested"), F.col("orgao").isNotNull().alias("listed"),
        )
    )


def _version_pages(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """Purchases as pages of three runs: orders that 3 divides are in the first two, and
    the third brings those that 5 divides at twice the price."""
    wanted = {1: _RUNS["run-1"], 2: _RUNS["run-2"], 3: "CAST(id_compra AS BIGINT) % 5 = 0"}[run]
    rows = _typed_purchases(spark, sf_dir).filter(wanted)
    record = F.to_json(
        F.struct(
            F.col("id_compra").alias("idCompra"),
            F.concat_ws("-", "id_item_compra", "arrival", F.col("quantidade").cast("int")).alias("idItemCompra"),
            "quantidade",
            (F.col("preco_unitario") * (2 if run == 3 else 1)).alias("precoUnitario"),
            F.date_format("data_compra", "yyyy-MM-dd").alias("dataCompra"),
        )
    )
    pages = rows.groupBy("codigo_item_catalogo", "id_compra").agg(F.array_join(F.array_sort(F.collect_list(record)), ",").alias("items"))
    return pages.select(
        F.lit(f"v-{run}").alias("run_id"), F.col("codigo_item_catalogo").alias("catmat"), F.lit("incremental").alias("extract_type"),
        F.col("id_compra").cast("int").alias("page"), F.lit("/precos").alias("endpoint"),
        F.concat(F.lit('{"totalPaginas":99999999,"resultado":['), "items", F.lit("]}")).alias("body"),
    )


_ITEM = "id_item_compra || '-' || arrival || '-' || CAST(quantidade AS INT)"
_VERSIONS_SQL = (
    f"p AS (SELECT DISTINCT id_compra, {_ITEM} AS id_item_compra, codigo_item_catalogo, quantidade, preco_unitario, data_compra"
    f" FROM {_TYPES_SQL} WHERE"
    f" (data_compra IS NULL OR data_compra >= TIMESTAMP '{START_DATE}')),"
    f" v1 AS (SELECT *, 1 AS run FROM p WHERE {_RUNS['run-1']}),"
    f" v2 AS (SELECT *, 2 AS run FROM p WHERE {_RUNS['run-2']}),"
    " v3 AS (SELECT * REPLACE (preco_unitario * 2 AS preco_unitario), 3 AS run FROM p WHERE CAST(id_compra AS BIGINT) % 5 = 0)"
)
_LATEST_SQL = (
    "SELECT * FROM {} QUALIFY row_number() OVER (PARTITION BY id_compra, id_item_compra, codigo_item_catalogo ORDER BY run DESC) = 1"
)
_VERSION_ROWS = (
    "id_compra, id_item_compra, codigo_item_catalogo, strftime(data_compra, '%Y-%m') AS ano_mes, 'v-' || run AS pipeline_run_id,"
    " round(preco_unitario, 4) + 0.0 AS preco_unitario"
)
_VERSION_COLUMNS = ("id_compra", "id_item_compra", "codigo_item_catalogo", "ano_mes", "pipeline_run_id", "preco_unitario")


@query(
    "load_scopes",
    f"""WITH {_VERSIONS_SQL}, a AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2 UNION ALL SELECT * FROM v3),
    l AS ({_LATEST_SQL.format('a')})
    SELECT scope, {_VERSION_ROWS} FROM l, (VALUES ('named'), ('whole')) s(scope) WHERE data_compra IS NOT NULL""",
)
def load_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs loaded into Silver file by file, and all at once: the same rows."""
    bronze, catalogue = new_path(spark, "scopes-bronze"), _type_entries(spark, sf_dir)
    paths = {scope: new_path(spark, f"{scope}-silver") for scope in ("named", "whole")}
    mapping = catalogue_mapping(catalogue)
    for run in (1, 2, 3):
        stamp = F.lit(f"2024-03-0{run}").cast("timestamp")
        run_bronze(spark, _version_pages(spark, sf_dir, run), catalogue, bronze, new_path(spark, "scopes-results"), ingested_at=stamp)
        of_run = read_bronze(spark, bronze).filter(F.col("_pipeline_run_id") == f"v-{run}")
        names = [x[0] for x in of_run.select("_bronze_object").distinct().collect()]
        run_silver(spark, bronze, paths["named"], mapping, names, SETTINGS)
    run_silver(spark, bronze, paths["whole"], mapping, settings=SETTINGS)
    rows = [read_silver(spark, path).select(F.lit(scope).alias("scope"), *_VERSION_COLUMNS) for scope, path in paths.items()]
    return comparable(rows[0].unionByName(rows[1]))


_LOADED_SQL = f"""{_VERSIONS_SQL},
    m1 AS (SELECT codigo_item_catalogo AS c, max(data_compra) AS mark FROM v1 GROUP BY ALL),
    b2 AS (SELECT v2.* FROM v2 LEFT JOIN m1 ON c = codigo_item_catalogo WHERE mark IS NULL OR data_compra IS NULL OR data_compra >= mark - to_days(30)),
    m2 AS (SELECT c, max(mark) AS mark FROM (SELECT * FROM m1 UNION ALL SELECT codigo_item_catalogo, data_compra FROM b2) GROUP BY ALL),
    b3 AS (SELECT v3.* FROM v3 LEFT JOIN m2 ON c = codigo_item_catalogo WHERE mark IS NULL OR data_compra IS NULL OR data_compra >= mark - to_days(30)),
    m3 AS (SELECT c, max(mark) AS mark FROM (SELECT * FROM m2 UNION ALL SELECT codigo_item_catalogo, data_compra FROM b3) GROUP BY ALL),
    a AS (SELECT * FROM v1 UNION ALL SELECT * FROM b2 UNION ALL SELECT * FROM b3)"""


_LAKES: dict[tuple[str, str], Lake] = {}


def _incremental_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Three incremental loads. The second one is cut off before its merge and called
    again, and the last one is called once more when it is done. Two queries look at
    the lake, so it is kept for the session."""
    of = (spark.sparkContext.applicationId, sf_dir)
    if of in _LAKES and path_exists(spark, _LAKES[of].path("audit")):
        return _LAKES[of]
    lake, catalogue = Lake(new_path(spark, "lake")), _type_entries(spark, sf_dir)
    calls = [(1, None), (2, "changes"), (2, None), (3, "merge"), (3, None), (3, None)]
    for run, stop_after in calls:
        incremental_load(
            spark, lake, f"v-{run}", _version_pages(spark, sf_dir, run), catalogue, SETTINGS, stop_after=stop_after
        )
    _LAKES[of] = lake
    return lake


@query(
    "incremental_load",
    f"WITH {_LOADED_SQL}, l AS ({_LATEST_SQL.format('a')}) SELECT {_VERSION_ROWS} FROM l WHERE data_compra IS NOT NULL",
)
def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _incremental_lake(spark, sf_dir)
    return comparable(read_silver(spark, lake.path("silver")).select(*_VERSION_COLUMNS))


_HELD = "(id_compra, id_item_compra, codigo_item_catalogo) IN (SELECT (id_compra, id_item_compra, codigo_item_catalogo) FROM {} WHERE data_compra IS NOT NULL)"


@query(
    "incremental_audit",
    f"""WITH {_LOADED_SQL}, h2 AS (SELECT * FROM v1 UNION ALL SELECT * FROM b2),
    f AS (SELECT 1 AS run, *, 'new' AS change FROM v1 UNION ALL
      SELECT 2, *, CASE WHEN {_HELD.format('v1')} THEN 'same' ELSE 'new' END FROM b2 UNION ALL
      SELECT 3, *, CASE WHEN {_HELD.format('h2')} THEN 'updated' ELSE 'new' END FROM b3),
    raw AS (SELECT DISTINCT id_compra, codigo_item_catalogo AS c FROM {_TYPES_SQL} WHERE codigo_item_catalogo IS NOT NULL),
    got AS (SELECT run, c, count(*) AS pages FROM (SELECT 1 AS run, * FROM raw WHERE {_RUNS['run-1']}
      UNION ALL SELECT 2, * FROM raw WHERE {_RUNS['run-2']} UNION ALL SELECT 3, * FROM raw WHERE CAST(id_compra AS BIGINT) % 5 = 0) GROUP BY ALL),
    every AS (SELECT run, p_type AS c FROM part, range(1, 4) r(run) WHERE p_size <> 13 GROUP BY ALL),
    k AS (SELECT run, codigo_item_catalogo AS c, count(*) FILTER (change = 'new') AS n, count(*) FILTER (change = 'updated') AS u,
      count(*) FILTER (change = 'same') AS s,
      count(*) FILTER (data_compra IS NULL OR coalesce(preco_unitario <= 0, true) OR coalesce(quantidade <= 0, true)) AS bad FROM f GROUP BY ALL),
    m AS (SELECT 1 AS run, c, NULL::TIMESTAMP AS before, mark AS after FROM m1
      UNION ALL SELECT 2, m2.c, m1.mark, m2.mark FROM m2 LEFT JOIN m1 ON m1.c = m2.c
      UNION ALL SELECT 3, m3.c, m2.mark, m3.mark FROM m3 LEFT JOIN m2 ON m2.c = m3.c)
    SELECT 'v-' || every.run AS run_id, CASE WHEN k.c IS NOT NULL THEN 'T-' || every.c END AS material_id, every.c AS catmat,
      coalesce(pages, 0) AS paginas_consultadas, k.n AS registros_novos, k.u AS registros_atualizados, k.s AS registros_duplicados,
      k.bad AS registros_invalidos, m.before AS watermark_anterior, m.after AS watermark_novo, 'SUCCESS' AS status
    FROM every LEFT JOIN got ON got.run = every.run AND got.c = every.c LEFT JOIN k ON k.run = every.run AND k.c = every.c
      LEFT JOIN m ON m.run = every.run AND m.c = every.c""",
)
def incremental_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit rows the three loads have left; times and record counts with repeats
    of the raw pages are left out."""
    lake = _incremental_lake(spark, sf_dir)
    rows = read_of_runs(spark, lake.path("audit"))
    return comparable(rows.drop("inicio", "fim", "duracao_segundos", "registros_recebidos", "outliers", "erro"))


@query(
    "repeated_load",
    f"""WITH raw AS (SELECT * FROM {_TYPES_SQL} WHERE codigo_item_catalogo IS NOT NULL AND {_RUNS['run-1']}),
    every AS (SELECT DISTINCT p_type AS c FROM part WHERE p_size <> 13)
    SELECT 'v-1' AS run_id, c AS catmat, 'SUCCESS' AS status, count(DISTINCT id_compra) AS pages_processed,
      count(id_compra) AS records_written, count(id_compra) AS records_held
    FROM every LEFT JOIN raw ON c = codigo_item_catalogo GROUP BY c""",
)
def repeated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run loaded in part, as a whole and once more: results and rows count once."""
    bronze, results, catalogue = new_path(spark, "again-bronze"), new_path(spark, "again-results"), _type_entries(spark, sf_dir)
    pages = stage(_version_pages(spark, sf_dir, 1), "again-pages")
    for attempt in (pages.filter("page % 2 = 0"), pages, pages):
        run_bronze(spark, attempt, catalogue, bronze, results)
    held = read_bronze(spark, bronze).groupBy(F.col("_catmat").alias("catmat")).agg(F.count(F.lit(1)).alias("records_held"))
    shown = read_of_runs(spark, results).select("run_id", "catmat", "status", "pages_processed", "records_written")
    return shown.join(held, "catmat", "left").withColumn("records_held", F.coalesce("records_held", F.lit(0)))


# ---- tables kept up to date by merges

# Purchase lines with several versions; the one that arrived last counts.
_LINE_COLUMNS = tuple(c for c in PURCHASE if c not in ("update_days", "codigo_item_catalogo"))
_LINES_SQL = (
    f"(SELECT * EXCLUDE (tipo), tipo AS codigo_item_catalogo FROM ({purchases_sql(_LINE_COLUMNS)}) WHERE data_compra >= TIMESTAMP '{START_DATE}'"
    " QUALIFY row_number() OVER (PARTITION BY id_compra, id_item_compra, tipo ORDER BY arrival DESC, data_compra DESC) = 1)"
)


def _line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases(spark, sf_dir, _LINE_COLUMNS).withColumnRenamed("tipo", "codigo_item_catalogo")
    rows = within_period(rows, START_DATE).filter("data_compra IS NOT NULL")
    rows = quality_flags(derived_columns(enrich(rows, catalogue_mapping(entries(spark, sf_dir)))))
    versioned = rows.withColumns(
        {
            "record_hash": F.expr("record_hash || '-' || CAST(arrival AS STRING)"),
            "ingestion_timestamp": F.timestamp_micros("arrival"),
        }
    )
    return stage(versioned, "line-versions")


@query(
    "maintained_limits",
    f"""WITH {flagged_sql(_LINES_SQL)} SELECT codigo_item_catalogo, ano_mes, count(preco_normalizado) AS group_rows,
      round(quantile_cont(preco_normalizado, 0.25), 4) + 0.0 AS q1, round(quantile_cont(preco_normalizado, 0.75), 4) + 0.0 AS q3
    FROM f GROUP BY ALL""",
)
def maintained_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of code and month after four merges, from counts that merges keep."""
    silver, counts = new_path(spark, "kept-silver"), new_path(spark, "kept-counts")
    rows = _line_versions(spark, sf_dir)
    for batch in range(4):
        merge_silver(spark, silver, rows.filter(F.col("arrival") % 4 == batch), SETTINGS, counts_path=counts, written=True)
    kept = PriceCounts(spark, counts, silver).read()
    found, _ = group_quantiles(kept, GROUP, PRICE, (0.25, 0.75), frequency="n")
    low, high = F.col("quantiles")[0], F.col("quantiles")[1]
    return comparable(found.select(*GROUP, "group_rows", low.alias("q1"), high.alias("q3")))


_REFRESHED_SQL = (
    f"{flagged_sql(_LINES_SQL)}, {IQR_SQL}, g AS (SELECT * FROM o WHERE {_ELIGIBLE} AND NOT is_outlier),"
    f" {mart_sql('mm', 'g', MONTHLY_DIMENSIONS)}, {indicators_sql('mi', 'mm', MONTHLY_SERIES)}"
)


@query("refreshed_marts", f"WITH {_REFRESHED_SQL} SELECT {_series_list(MONTHLY_DIMENSIONS)} FROM mi")
def refreshed_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly mart after three merges, each followed by a refresh of the groups
    and series it has touched."""
    silver, gold, touched = (new_path(spark, f"refreshed-{n}") for n in ("silver", "gold", "touched"))
    rows = _line_versions(spark, sf_dir)
    for batch in range(3):
        merge_silver(spark, silver, rows.filter(F.col("arrival") % 3 == batch), SETTINGS, touched_path=touched, written=True)
        refresh_gold(spark, silver, gold, touched, SETTINGS)
    return _series(read_of_codes(spark, f"{gold}/{MONTHLY_TABLE}"), MONTHLY_DIMENSIONS)


@query("clustered_marts", f"WITH {MONTHLY_SQL} SELECT {_mart_list(MONTHLY_DIMENSIONS)} FROM mm")
def clustered_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits and the monthly mart from a table clustered by code and month."""
    table = f"clustered_{uuid.uuid4().hex}"
    cleaned = stage(flagged_purchases(spark, sf_dir), "purchases")
    write_clustered(cleaned, table, buckets=max(8, bucket_count(cleaned.count())))
    try:
        eligible = eligible_records(iqr_outliers(read_clustered(spark, table)))
        mart = stage(monthly_mart(eligible, dated=True), "clustered-mart")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return comparable(mart.select(*MONTHLY_DIMENSIONS, *METRICS, "coeficiente_variacao_pct"))


@query(
    "layer_results",
    f"""WITH {flagged_sql(_LINES_SQL)}, {IQR_SQL}
    SELECT 'gold' AS layer, 'SUCCESS' AS status, count(*) AS records_input,
      count(*) FILTER (WHERE {_ELIGIBLE} AND NOT is_outlier) AS records_valid, 0 AS failed FROM o
    UNION ALL SELECT 'gold', 'FAILED', 0, 0, 1""",
)
def kept_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a Gold run over merged Silver and of one over no Silver at all."""
    silver, gold, results = (new_path(spark, f"results-{n}") for n in ("silver", "gold", "table"))
    merge_silver(spark, silver, _line_versions(spark, sf_dir), SETTINGS, written=True)
    run_gold(spark, silver, gold, SETTINGS, results_path=results, run_id="g-1")
    try:
        run_gold(spark, f"{silver}-none", gold, SETTINGS, results_path=results, run_id="g-2")
    except SchemaError:
        pass
    number = lambda name: F.coalesce(F.try_element_at("metrics", F.lit(name)), F.lit(0))
    return layer_results(spark, results).select(
        "layer", "status", number("records_input").alias("records_input"), number("records_valid").alias("records_valid"),
        F.col("error").isNotNull().cast("int").alias("failed"),
    )


_LAST = "TIMESTAMP '2030-01-01'"


@query(
    "page_completeness_stream",
    _STATUS
    + """, w AS (SELECT run_id, catmat, max(last_landed) AS last_landed, min(stop) AS stop FROM (
      SELECT run_id, catmat, page AS last_landed, CASE WHEN coalesce(page >= declared_pages, false)
        OR (declared_pages IS NULL AND records < 2) THEN page END AS stop FROM facts) GROUP BY ALL),
    n AS (SELECT w.run_id, w.catmat, stop, last_landed, count(f.page) AS landed FROM w LEFT JOIN facts f
      ON f.run_id = w.run_id AND f.catmat = w.catmat AND (stop IS NULL OR f.page <= stop) GROUP BY ALL),
    l AS (SELECT f.run_id, f.catmat, f.page, lag(f.page, 1, 0) OVER (PARTITION BY f.run_id, f.catmat ORDER BY f.page) AS before, stop
      FROM facts f JOIN w ON w.run_id = f.run_id AND w.catmat = f.catmat WHERE stop IS NULL OR f.page <= stop)
    SELECT run_id, catmat, 'complete' AS event, CAST(1 AS BIGINT) AS page, CAST(stop AS BIGINT) AS last_page FROM n WHERE landed = stop
    UNION ALL SELECT run_id, catmat, 'unfinished', 1, last_landed FROM n WHERE stop IS NULL
    UNION ALL SELECT run_id, catmat, 'gap', before + 1, page - 1 FROM l WHERE page > before + 1""",
)
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of landed pages, in two parts of a stream that is started twice, and a
    last page that lets time pass over all others."""
    folder, out, state = (new_path(spark, f"completeness-{n}") for n in ("pages", "events", "state"))
    pages = landed_pages(spark, sf_dir).withColumn("landed_at", F.lit("2024-01-01").cast("timestamp"))
    pages = stage(pages, "completeness-landed")
    last = pages.limit(1).withColumns({"catmat": F.lit("last"), "landed_at": F.expr(_LAST)})
    for part in (pages.filter("page % 2 = 0"), pages.filter("page % 2 = 1"), last):
        part.write.mode("append").parquet(folder)
        stream_query = start_completeness_stream(spark, page_stream(spark, folder), out, state, PAGE_SIZE)
        stream_query.awaitTermination()
    return spark.read.schema(EVENTS).parquet(out).filter("catmat <> 'last'")
