import json
from datetime import datetime
from threading import Thread

import pytest
from pyspark.sql import functions as F, types as T

from pricegrid.fixed_values import AUDIT_COLUMNS, MONTHLY_TABLE, STATE_TABLE
from pricegrid.operators.catalogue import catalogue_entries, catalogue_mapping, enrich
from pricegrid.operators.derive import derived_columns
from pricegrid.operators.hashes import field_hash
from pricegrid.operators.price_index import weighted_index
from pricegrid.operators.quality import quality_flags
from pricegrid.operators.units import convert_units
from pricegrid.plans.bronze import run_bronze
from pricegrid.plans.gold import run_gold
from pricegrid.plans.incremental import (
    WATERMARK_SCHEMA,
    advance_watermarks,
    classify_changes,
    merge_silver,
    since_watermark,
    touched_partitions,
)
from pricegrid.plans.results import all_results, audit_rows, failed_materials, run_summary
from pricegrid.plans.silver import run_silver, sorted_silver
from pricegrid.settings import DataQualityError, SchemaError, Settings
from pricegrid.sources.database import publish
from pricegrid.sources.landed import PAGE_SCHEMA
from pricegrid.sources.tables import read_bronze, read_silver, write_silver, write_snapshot
from pricegrid.staging import path_exists, stage, stage_scope, unstage
from pricegrid.streaming.pages import page_stream, start_silver_stream

RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("idCompra", "idItemCompra", "dataCompra", "estado")]
    + [T.StructField(n, T.DoubleType()) for n in ("quantidade", "precoUnitario")]
)
LANDED = T.StructType([*PAGE_SCHEMA.fields, T.StructField("landed_at", T.TimestampType())])
SETTINGS = Settings(base_period="2024-01")


def record(order, item, price, date, uf="SP"):
    return {"idCompra": order, "idItemCompra": item, "quantidade": 2.0, "precoUnitario": price, "dataCompra": date, "estado": uf}


def page(records, run="r1", code="00456", number=1, at=datetime(2024, 6, 1)):
    return (run, code, "full", number, "/e", json.dumps({"resultado": records, "totalPaginas": 99}), at)


@pytest.fixture(scope="module")
def entries(spark):
    return catalogue_entries(spark, [{"catmat": "00456", "material_id": "M1", "nome": "Cimento", "unidade_padrao": "kg"}, {"catmat": "7", "nome": "Areia"}])


def rows_of(path, spark):
    return sorted((r.id_compra, r.id_item_compra, r.preco_unitario) for r in read_silver(spark, path).collect())


def cleaned(spark, records, mapping):
    rows = spark.createDataFrame(
        records,
        "codigo_item_catalogo string, id_compra string, id_item_compra string, preco_unitario double, quantidade double,"
        " data_compra string, record_hash string, ingestion_timestamp string, descricao_item string, unidade_original string, uf string",
    ).withColumns({c: F.col(c).cast("timestamp") for c in ("data_compra", "ingestion_timestamp")})
    return quality_flags(derived_columns(enrich(rows, mapping)))


def line(order, price, date, hash_, at, code="00456"):
    return (code, order, "1", price, 1.0, date, hash_, at, "d", "kg", "SP")


def test_layers_end_to_end(spark, entries, tmp_path):
    bronze, results, silver, gold = (str(tmp_path / n) for n in ("b", "r", "s", "g"))
    landed = spark.createDataFrame(
        [
            page([record(str(i), "1", 10.0 + i, f"2024-0{i % 3 + 1}-05") for i in range(12)]),
            page([record("0", "1", 10.0, "2024-01-05"), record("99", "1", 5.0, "2019-01-01"), record("98", "1", -5.0, "2024-01-01")], number=2),
            page([record("1", "1", 1.0, None)], code="7"),
        ],
        LANDED,
    ).drop("landed_at")
    run_bronze(spark, landed, entries, bronze, results, RECORD)
    mapping = catalogue_mapping(entries)
    for _ in range(2):  # a second run changes nothing
        m = run_silver(spark, bronze, silver, mapping, settings=SETTINGS).first()
        assert (m.records_input, m.records_output, m.duplicates_removed, m.invalid_records) == (16, 14, 1, 2)
        rows = read_silver(spark, silver)
        assert rows.count() == 13  # the record without a date has no partition
        assert {(r.catmat, r.material_id) for r in rows.select("catmat", "material_id").collect()} == {("00456", "M1")}
        g = run_gold(spark, silver, gold, SETTINGS, partitions=("ano", "mes")).first()
        assert (g.records_input, g.records_valid, g.records_invalid, g.monthly_records, g.regional_records) == (13, 12, 1, 3, 3)
    monthly = spark.read.parquet(f"{gold}/{MONTHLY_TABLE}")
    assert monthly.agg(F.sum("quantidade_compras")).first()[0] == 12
    assert monthly.filter("ano_mes = '2024-01'").first().indice_base_100 == 100.0
    assert spark.read.parquet(f"{gold}/{STATE_TABLE}").first().regiao == "Sudeste"
    assert [r.catmat for r in sorted_silver(rows).select("catmat").limit(1).collect()] == ["00456"]


def test_named_objects_only(spark, entries, tmp_path):
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    for n in (1, 2):
        landed = spark.createDataFrame([page([record(str(n), "1", 1.0, "2024-01-05")], number=n)], LANDED).drop("landed_at")
        run_bronze(spark, landed, entries, bronze, str(tmp_path / "r"), RECORD)
    second = read_bronze(spark, bronze).filter("_page = 2")
    objects = [r["_bronze_object"] for r in second.collect()]
    m = run_silver(spark, bronze, silver, catalogue_mapping(entries), objects, SETTINGS).first()
    assert m.records_input == 1 and rows_of(silver, spark) == [("2", "1", 1.0)]
    first = [r["_bronze_object"] for r in read_bronze(spark, bronze).filter("_page = 1").collect()]
    run_silver(spark, bronze, silver, catalogue_mapping(entries), first, SETTINGS)
    assert rows_of(silver, spark) == [("1", "1", 1.0), ("2", "1", 1.0)]  # other runs' records stay


def test_full_load_removes_what_is_gone(spark, entries, tmp_path):
    bronze, silver, mapping = str(tmp_path / "b"), str(tmp_path / "s"), catalogue_mapping(entries)
    write_silver(cleaned(spark, [line("5", 1.0, "2024-03-01", "a", "2024-01-01")], mapping), silver)
    landed = spark.createDataFrame([page([record("1", "1", 1.0, "2024-01-05")])], LANDED).drop("landed_at")
    run_bronze(spark, landed, entries, bronze, str(tmp_path / "r"), RECORD)
    run_silver(spark, bronze, silver, mapping, settings=SETTINGS)
    assert rows_of(silver, spark) == [("1", "1", 1.0)]


def test_replay_without_hash_and_key_changes_nothing(spark, entries, tmp_path):
    path, mapping = str(tmp_path / "s"), catalogue_mapping(entries)
    loose = [("00456", "1", None, p, 1.0, "2024-01-01", None, "2024-02-01", "d", "kg", "SP") for p in (1.0, 2.0)]
    rows = cleaned(spark, loose, mapping)
    assert merge_silver(spark, path, rows, SETTINGS).first().asDict() == {"new": 2, "updated": 0, "same": 0}
    again = rows.withColumn("ingestion_timestamp", F.lit("2024-03-01").cast("timestamp"))
    assert merge_silver(spark, path, again, SETTINGS).first().asDict() == {"new": 0, "updated": 0, "same": 2}
    assert read_silver(spark, path).count() == 2


def test_merge_reads_only_the_codes_of_a_batch(spark, entries, tmp_path):
    path, mapping = str(tmp_path / "s"), catalogue_mapping(entries)
    old = [line(str(i), 1.0, "2024-01-01", f"h{i}", "2024-01-01", code=str(i)) for i in range(8)]
    merge_silver(spark, path, cleaned(spark, old, mapping), SETTINGS)
    batch = stage(cleaned(spark, old[:2], mapping), "batch")
    held = touched_partitions(batch, read_silver(spark, path))
    assert "dynamicpruning" in held._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.catmat for r in held.collect()) == ["0", "1"]


def test_repeated_keys_of_dimensions_are_errors(spark, entries):
    rows = cleaned(spark, [line("1", 1.0, "2024-01-01", "a", "2024-01-01")], catalogue_mapping(entries))
    twice = catalogue_mapping(entries).filter("codigo_item_catalogo = '00456'")
    marks = spark.createDataFrame([("00456", datetime(2024, 1, 1))] * 2, "codigo_catmat string, watermark timestamp")
    rules = spark.createDataFrame([("kg", "t", 1.0)] * 2, "de string, para string, fator double")
    index = spark.createDataFrame([("2024-01", "M1", 100.0)], "ano_mes string, material_id string, indice_base_100 double")
    weights = spark.createDataFrame([("M1", 1.0)] * 2, "material_id string, peso double")
    undated = rows.withColumn("data_hora_atualizacao_item", F.lit(None).cast("timestamp"))
    for join in (
        lambda: enrich(rows, twice.unionByName(twice)),
        lambda: since_watermark(undated, marks),
        lambda: convert_units(rows, rules),
        lambda: weighted_index(index, weights),
    ):
        with pytest.raises(DataQualityError):
            join()


def test_scopes_belong_to_their_thread(spark):
    kept = []
    with stage_scope(spark):
        worker = Thread(target=lambda: kept.append(stage(spark.range(2), "x")))
        worker.start()
        worker.join()
    assert kept[0].count() == 2


def test_other_time_zones_are_refused(spark, entries, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            run_silver(spark, str(tmp_path), str(tmp_path), catalogue_mapping(entries))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_silver_partitions_are_replaced_not_added_to(spark, entries, tmp_path):
    path, mapping = str(tmp_path / "s"), catalogue_mapping(entries)
    write_silver(cleaned(spark, [line("1", 1.0, "2024-01-01", "a", "2024-01-01"), line("2", 1.0, "2024-02-01", "b", "2024-01-01")], mapping), path)
    write_silver(cleaned(spark, [line("3", 1.0, "2024-02-09", "c", "2024-01-01")], mapping), path)
    assert [r[0] for r in rows_of(path, spark)] == ["1", "3"]
    plan = read_silver(spark, path).filter("catmat = '00456'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(catmat" in plan
    with pytest.raises(SchemaError):
        read_silver(spark, str(tmp_path / "none"))


def test_watermarks_restrict_only_known_codes(spark):
    marks = spark.createDataFrame([("1", datetime(2024, 1, 10))], "codigo_catmat string, watermark timestamp")
    rows = spark.createDataFrame(
        [("1", "2024-01-09", 1), ("1", "2024-01-10", 2), ("2", "2020-01-01", 3), (None, "2020-01-01", 4), ("1", None, 5)],
        "codigo_item_catalogo string, data_compra string, i int",
    ).withColumns({"data_compra": F.col("data_compra").cast("timestamp"), "data_hora_atualizacao_item": F.lit(None).cast("timestamp")})
    assert sorted(r.i for r in since_watermark(rows, marks).collect()) == [2, 3, 4, 5]
    assert sorted(r.i for r in since_watermark(rows, marks, lookback_days=1).collect()) == [1, 2, 3, 4, 5]


def test_watermarks_advance_on_success_only(spark):
    old = spark.createDataFrame(
        [(None, "1", datetime(2024, 1, 1), None, None, datetime(2024, 1, 2), "SUCCESS"), (None, "2", datetime(2024, 1, 1), None, None, None, None), (None, "3", datetime(2025, 1, 1), None, None, None, None)],
        WATERMARK_SCHEMA,
    )
    rows = spark.createDataFrame(
        [("1", "2024-03-01", "2024-04-01"), ("2", "2024-03-01", None), ("3", "2024-03-01", None), ("4", "2024-03-01", None)],
        "codigo_item_catalogo string, data_compra string, data_hora_atualizacao_item string",
    ).select("codigo_item_catalogo", F.col("data_compra").cast("timestamp"), F.col("data_hora_atualizacao_item").cast("timestamp"), F.lit("M").alias("material_id"), F.lit(None).cast("timestamp").alias("ingestion_timestamp"))
    results = spark.createDataFrame([("1", "SUCCESS"), ("2", "FAILED"), ("3", "SUCCESS"), ("4", "SUCCESS")], "catmat string, status string")
    got = {r.codigo_catmat: r.watermark for r in advance_watermarks(old, rows, results, F.lit("2024-05-01").cast("timestamp")).collect()}
    assert got == {"1": datetime(2024, 4, 1), "2": datetime(2024, 1, 1), "3": datetime(2025, 1, 1), "4": datetime(2024, 3, 1)}


def test_changes(spark, entries):
    mapping = catalogue_mapping(entries)
    old = cleaned(spark, [line("1", 1.0, "2024-01-01", "a", "2024-01-01"), line("2", 1.0, "2024-01-01", "b", "2024-01-01")], mapping)
    new = cleaned(
        spark,
        [line("1", 1.0, "2024-01-01", "a", "2024-02-01"), line("2", 2.0, "2024-01-01", "c", "2024-02-01"), line("3", 1.0, "2024-01-01", "d", "2024-02-01"), line("4", 1.0, "2024-01-01", None, "2024-02-01"), line("2", 1.0, "2024-01-01", "e", "2024-02-01", code=None)],
        mapping,
    )
    got = sorted((r.id_compra, r.record_hash or "", r.change) for r in classify_changes(new, old).collect())
    assert got == [("1", "a", "same"), ("2", "c", "updated"), ("2", "e", "new"), ("3", "d", "new"), ("4", "", "new")]


def test_merge_moves_lines_between_months_and_is_idempotent(spark, entries, tmp_path):
    path, mapping = str(tmp_path / "s"), catalogue_mapping(entries)
    first = cleaned(spark, [line("1", 1.0, "2024-01-01", "a", "2024-01-01"), line("2", 1.0, "2024-02-01", "b", "2024-01-01"), line("3", 1.0, "2024-03-01", "c", "2024-01-01")], mapping)
    second = cleaned(spark, [line("1", 9.0, "2024-02-15", "d", "2024-05-01"), line("4", 4.0, "2024-02-20", "e", "2024-05-01")], mapping)
    assert merge_silver(spark, path, first, SETTINGS).first().asDict() == {"new": 3, "updated": 0, "same": 0}
    assert merge_silver(spark, path, second, SETTINGS).first().asDict() == {"new": 1, "updated": 1, "same": 0}
    expected = [("1", "1", 9.0), ("2", "1", 1.0), ("3", "1", 1.0), ("4", "1", 4.0)]
    assert rows_of(path, spark) == expected
    assert not path_exists(spark, f"{path}/catmat=00456/ano=2024/mes=01")
    assert merge_silver(spark, path, second, SETTINGS).first().asDict() == {"new": 0, "updated": 0, "same": 2}
    assert rows_of(path, spark) == expected
    assert merge_silver(spark, path, second.limit(0), SETTINGS).first().asDict() == {"new": 0, "updated": 0, "same": 0}


def test_results_and_audit(spark, entries):
    bronze = spark.createDataFrame(
        [("r", "1", "FULL", p, f"2024-01-01T00:00:0{p}+00:00") for p in (1, 1, 2)],
        "_pipeline_run_id string, _catmat string, _extract_type string, _page int, _ingestion_timestamp string",
    )
    rejects = spark.createDataFrame([("r", "2", "full", "NOT_JSON")], "run_id string, catmat string, extract_type string, reject_reason string")
    results = all_results(bronze, rejects)
    rows = {r.catmat: r for r in results.collect()}
    assert (rows["1"].status, rows["1"].pages_processed, rows["1"].records_written, rows["1"].duration_seconds) == ("SUCCESS", 2, 3, 1.0)
    assert (rows["2"].status, rows["2"].pages_processed, rows["2"].error) == ("FAILED", 0, "NOT_JSON")
    s = run_summary(results).first()
    assert (s.materials_processed, s.materials_success, s.materials_failed, s.records_written, s.status) == (2, 1, 1, 3, "PARTIAL_SUCCESS")
    assert [r.catmat for r in failed_materials(results).collect()] == ["2"]
    silver = spark.createDataFrame([("1", "M", False, True), ("1", "M", True, False)], "codigo_item_catalogo string, material_id string, is_valid_record boolean, is_outlier boolean")
    changes = spark.createDataFrame([("1", "new"), ("1", "same"), ("1", "new")], "catmat string, change string")
    marks = spark.createDataFrame([("1", datetime(2024, 1, 1))], "codigo_catmat string, watermark timestamp")
    audit = audit_rows(results, silver, changes, marks, marks)
    assert tuple(audit.columns) == AUDIT_COLUMNS
    r = audit.filter("catmat = '1'").first()
    assert (r.material_id, r.registros_novos, r.registros_atualizados, r.registros_duplicados, r.registros_invalidos, r.outliers) == ("M", 2, 0, 1, 1, 1)
    assert r.watermark_anterior == r.watermark_novo == datetime(2024, 1, 1)


def test_field_hash_tells_null_from_empty(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string")
    got = [r.h for r in rows.select(field_hash(["x", "y"]).alias("h")).collect()]
    assert got[0] == got[2] != got[1]


def test_empty_frames_are_not_written(spark, tmp_path):
    empty = spark.createDataFrame([], "a int")
    assert write_snapshot(empty, str(tmp_path / "x")) is False and not (tmp_path / "x").exists()
    assert publish(empty, "jdbc:none", "t") == 0


def test_scoped_stages_are_deleted(spark):
    with stage_scope(spark):
        df = stage(spark.range(3), "x")
        folder = df.inputFiles()[0].rsplit("/", 1)[0]
        assert path_exists(spark, folder)
    assert not path_exists(spark, folder)


def test_a_stage_can_go_before_its_scope(spark):
    with stage_scope(spark):
        kept, gone = stage(spark.range(3), "x"), stage(spark.range(3), "y")
        folder = gone.inputFiles()[0].rsplit("/", 1)[0]
        unstage(gone)
        assert not path_exists(spark, folder) and kept.count() == 3
        unstage(gone)
        unstage(spark.range(3))  # not a staged table


def test_stream_equals_batch(spark, entries, tmp_path):
    mapping = catalogue_mapping(entries)
    folder, silver = tmp_path / "landing", str(tmp_path / "s")
    first = [page([record("1", "1", 10.0, "2024-01-05"), record("2", "1", 20.0, "2024-02-05")]), page([record("9", "1", 1.0, "2019-01-05")], number=2)]
    second = [page([record("1", "1", 10.0, "2024-01-05"), record("2", "1", 25.0, "2024-02-07"), record("3", "1", 5.0, "2024-01-09")], run="r2", at=datetime(2024, 6, 2))]
    late = [page([record("7", "1", 3.0, "2024-02-01")], run="r0", at=datetime(2024, 3, 10))]
    for pages in (first, second, late):
        spark.createDataFrame(pages, LANDED).coalesce(1).write.mode("append").parquet(str(folder))
        query = start_silver_stream(page_stream(spark, str(folder)), RECORD, mapping, silver, str(tmp_path / "state"), SETTINGS)
        query.awaitTermination()
        assert query.exception() is None
    assert rows_of(silver, spark) == [("1", "1", 10.0), ("2", "1", 25.0), ("3", "1", 5.0), ("7", "1", 3.0)]
