import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from pricegrid.operators.catalogue import active_entries, catalogue_entries, catalogue_mapping, enrich
from pricegrid.plans.bronze import run_bronze
from pricegrid.settings import DataQualityError, SchemaError
from pricegrid.sources.catalogue_file import read_catalogue
from pricegrid.sources.landed import (
    PAGE_SCHEMA,
    bronze_records,
    page_rows,
    parsed_pages,
    rejected_pages,
    settled_pages,
    with_metadata,
)
from pricegrid.sources import manifest as manifest_source
from pricegrid.sources.manifest import manifest_objects, require_objects
from pricegrid.sources.page_order import page_facts, page_status, sequence_results
from pricegrid.sources.tables import read_bronze

BODIES = [
    ('{"resultado":[{"a":1},{"a":2},3],"totalPaginas":"7"}', 2, 7, None),
    ('{"data":{"items":[{"a":9}]},"meta":{"pages":3}}', 1, 3, None),
    ('[{"a":5}]', 1, None, None),
    ('{"a":6}', 1, None, None),
    ('{"resultado":[]}', 0, None, None),
    ('{"resultado":[],"data":[{"a":1}]}', 0, None, None),
    ('{"resultado":{"x":{}},"data":[{"a":1}]}', 1, None, None),
    ('{"resultado":{"a":1},"pages":"x","total_pages":4.7}', 1, 4, None),
    ('{"total_paginas":null,"pagination":{"pages":2},"b":[1]}', 0, 2, None),
    ("{}", 0, None, None),
    ("null", 0, None, None),
    ("oops", 0, None, "NOT_JSON"),
    ('{"data":' * 6 + '[{"a":1}]' + "}" * 6, 0, None, "TOO_DEEP"),
    ('{"resultado":{"items":[]},"data":[{"a":1}]}', 1, None, None),
    ('{"data":' * 3 + '{"items":[]}' + "}" * 3, 0, None, None),
]


def pages(spark, bodies):
    rows = [("r1", "00456", "full", i + 1, "/e", b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def test_envelopes(spark):
    got = parsed_pages(pages(spark, [b[0] for b in BODIES])).orderBy("page").collect()
    assert [(len(r.records), r.declared_pages, r.reject_reason) for r in got] == [b[1:] for b in BODIES]


def extracted(value):
    """The rule for records, by recursion."""
    if isinstance(value, list):
        return [x for x in value if isinstance(x, dict)]
    if not isinstance(value, dict):
        return []
    for key in ("resultado", "resultados", "data", "dados", "items", "content", "registros"):
        inner = value.get(key)
        if isinstance(inner, list):
            return extracted(inner)
        if isinstance(inner, dict) and (found := extracted(inner)):
            return found
    return [value] if value and not any(isinstance(v, (list, dict)) for v in value.values()) else []


def test_envelopes_of_any_depth(spark):
    r = random.Random(5)

    def made(depth):
        if not depth:
            return r.choice([[{"a": r.randrange(9)}, 3], [], {"a": 1}, {}, {"x": [1]}, None, [{"b": 2}]])
        keys = r.sample(["resultado", "data", "items", "registros", "other"], r.choice([1, 2, 2]))
        return {k: made(depth - 1 if i == 0 else r.randrange(depth)) for i, k in enumerate(keys)}

    bodies = [made(r.randrange(4, 10)) for _ in range(60)]
    bodies += [json.loads('{"data":' * d + '[{"a":1}]' + "}" * d) for d in (5, 8, 12)]
    landed = pages(spark, [*map(json.dumps, bodies), "oops"])
    assert parsed_pages(landed).where("reject_reason = 'TOO_DEEP'").count() > 20
    assert [x.page for x in rejected_pages(landed).collect()] == [64]
    got = settled_pages(landed)
    rows = page_rows(got).select("page", "position", F.to_json("record").alias("record")).orderBy("page", "position")
    found = [(x.page, x.position, json.loads(x.record)) for x in rows.collect()]
    assert found == [(i + 1, k, x) for i, b in enumerate(bodies) for k, x in enumerate(extracted(b))]
    assert got.count() == 64 and page_rows(landed).count() == len(found) > 30


def test_rejects_do_not_stop_the_others(spark):
    landed = pages(spark, ["oops", '[{"a":1}]'])
    assert [r.page for r in rejected_pages(landed).collect()] == [1]
    assert page_rows(landed).count() == 1


def test_metadata_and_hash(spark):
    record = {"z": "é", "a": {"y": 1, "b": [2, "x"]}}
    landed = pages(spark, [json.dumps([record])])
    row = with_metadata(page_rows(landed)).first()
    canonical = json.dumps(record, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    assert row["_record_hash"] == hashlib.sha256(canonical.encode()).hexdigest()
    assert (row["_catmat"], row["_page"], row["_extract_type"]) == ("00456", 1, "FULL")
    assert row["_pipeline_run_id"] == "r1" and row["_source_endpoint"] == "/e"
    assert row["_ingestion_timestamp"].endswith("+00:00")


def test_same_record_same_hash_whatever_the_key_order(spark):
    rows = with_metadata(page_rows(pages(spark, ['[{"a":1,"b":2},{"b":2,"a":1}]']))).collect()
    assert rows[0]["_record_hash"] == rows[1]["_record_hash"]


def test_nested_objects_flatten_and_lists_stay(spark):
    landed = pages(spark, ['[{"orgao":{"codigo":"7","nome":{"x":1}},"itens":[1,2]},{"orgao":null}]'])
    got = bronze_records(landed)
    assert {"orgao__codigo", "orgao__nome__x", "itens"} <= set(got.columns)
    assert sorted(map(str, (r.itens for r in got.collect()))) == ["None", "[1.0, 2.0]"]


def facts(spark, rows):
    return spark.createDataFrame(
        rows, "run_id string, catmat string, page int, records bigint, declared_pages int"
    )


def test_page_sequences(spark):
    got = facts(
        spark,
        [
            ("r", "declared", 1, 3, 3), ("r", "declared", 2, 3, 3), ("r", "declared", 3, 1, 3),
            ("r", "declared", 4, 3, 3),
            ("r", "short", 1, 3, None), ("r", "short", 2, 2, None), ("r", "short", 3, 3, None),
            ("r", "empty", 1, 3, None), ("r", "empty", 2, 0, None),
            ("r", "gap", 1, 3, None), ("r", "gap", 3, 1, None),
            ("r", "open", 1, 3, None),
        ],
    )
    for bound in (200_000, 0):
        status = page_status(got, page_size=3, broadcast_rows=bound)
        seen = {(r.catmat, r.page): r.status for r in status.collect()}
        assert seen == {
            ("declared", 1): "accepted", ("declared", 2): "accepted", ("declared", 3): "accepted",
            ("declared", 4): "past_stop",
            ("short", 1): "accepted", ("short", 2): "accepted", ("short", 3): "past_stop",
            ("empty", 1): "accepted", ("empty", 2): "empty",
            ("gap", 1): "accepted", ("gap", 2): "missing", ("gap", 3): "after_gap",
            ("open", 1): "accepted",
        }
    complete = {r.catmat: (r.complete, r.records_accepted) for r in sequence_results(got, 3).collect()}
    assert complete == {
        "declared": (True, 7), "short": (True, 5), "empty": (True, 3), "gap": (False, 3),
        "open": (False, 3),
    }


def test_pages_are_counted_from_bodies(spark):
    landed = pages(spark, ['[{"a":1}]', "oops", "[]"])
    got = {r.page: r.records for r in page_facts(parsed_pages(landed)).collect()}
    assert got == {1: 1, 3: 0}


def test_catalogue_file(spark, tmp_path):
    file = tmp_path / "c.yml"
    file.write_text(
        "materiais:\n"
        "  - {material_id: M1, nome: Cimento, categoria: cimento, catmat: 10, unidade_padrao: kg, ativo: true}\n"
        "  - {material_id: M2, name: Areia, catmat: '20.0', active: true}\n"
        "  - {material_id: M3, nome: Brita, catmat: 30, ativo: false}\n"
        "  - {material_id: M4, nome: Sem codigo, catmat: null}\n"
        "  - {nome: Cimento novo, catmat: 10}\n"
        "  - {nome: Vazio, catmat: 40, ativo: null}\n"
    )
    entries = read_catalogue(spark, file)
    assert active_entries(entries).count() == 4
    got = {r.codigo_item_catalogo: (r.material_id, r.material) for r in catalogue_mapping(entries).collect()}
    assert got == {"10": ("10", "Cimento novo"), "20": ("M2", "Areia")}


def test_catalogue_must_be_a_list(spark, tmp_path):
    file = tmp_path / "c.yml"
    file.write_text("materials: {a: 1}\n")
    with pytest.raises(SchemaError):
        read_catalogue(spark, file)


def test_enrichment_with_and_without_catalogue(spark):
    rows = spark.createDataFrame(
        [("10", "desc", "old"), ("99", "other", "old"), (None, "none", "old")],
        "codigo_item_catalogo string, descricao_item string, material string",
    )
    mapping = catalogue_mapping(catalogue_entries(spark, [{"catmat": 10, "nome": "Cimento"}]))
    got = {r.descricao_item: (r.material_id, r.material) for r in enrich(rows, mapping).collect()}
    assert got == {"desc": ("10", "Cimento"), "other": (None, None), "none": (None, None)}
    empty = catalogue_mapping(catalogue_entries(spark, []))
    got = {r.descricao_item: (r.material_id, r.material) for r in enrich(rows, empty).collect()}
    assert got == {"desc": ("10", "desc"), "other": ("99", "other"), "none": (None, "none")}


def test_manifests(spark):
    manifest = json.dumps(
        {"objects": ["a", {"object_name": "b"}, 3, "a"], "results": [{"objects": ["c", "b"], "results": [{"objects": ["d"]}]}, 5]}
    )
    rows = spark.createDataFrame([(1, manifest), (2, json.dumps([{"objects": ["z"]}])), (3, "{}")], "id int, manifest string")
    got = manifest_objects(rows).orderBy("id", "position").collect()
    assert [(r.id, r.object_name) for r in got] == [(1, "a"), (1, "b"), (1, "c"), (1, "d"), (2, "z")]
    with pytest.raises(DataQualityError):
        require_objects(manifest_objects(rows.filter("id = 3")))


def test_deep_manifests(spark):
    manifest = {"objects": ["z7"]}
    for n in range(6, 0, -1):
        manifest = {"results": [{"objects": [f"y{n}"]}, manifest], "objects": [f"z{n}"]}
    rows = spark.createDataFrame([(1, json.dumps(manifest))], "id int, manifest string")
    got = [r.object_name for r in manifest_objects(rows).orderBy("position").collect()]
    assert got == ["z1", "y1", "z2", "y2", "z3", "y3", "z4", "y4", "z5", "y5", "z6", "y6", "z7"]


def test_two_loads_with_other_values_are_read_together(spark, tmp_path):
    entries = catalogue_entries(spark, [{"catmat": "00456"}])
    bronze = str(tmp_path / "bronze")
    bodies = ('[{"p":10.5,"q":null,"l":[]}]', '[{"p":10.25,"q":7,"l":[{"x":1}]}]', '[{"p":3,"q":null,"l":[{"x":2.5}]}]')
    for n, body in enumerate(bodies):  # runs of their own: a page of one run is only written once
        landed = pages(spark, [body]).withColumn("run_id", F.lit(f"run-{n}"))
        run_bronze(spark, landed, entries, bronze, str(tmp_path / "results"))
    read = read_bronze(spark, bronze).orderBy("p")
    assert [(r.p, r.q, r.l and r.l[0].x) for r in read.collect()] == [(3.0, None, 2.5), (10.25, 7.0, 1.0), (10.5, None, None)]


def test_results_of_codes_without_records(spark, tmp_path):
    landed = pages(spark, ['[{"a":1}]']).unionByName(
        spark.createDataFrame([("r1", "7", "full", 1, "/e", "[]")], PAGE_SCHEMA)
    )
    entries = catalogue_entries(spark, [{"catmat": "00456"}, {"catmat": "7"}, {"catmat": "8"}])
    run_bronze(spark, landed, entries, str(tmp_path / "b"), str(tmp_path / "r"))
    got = {r.catmat: (r.run_id, r.status, r.pages_processed, r.records_written, r.extract_type) for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert got == {"00456": ("r1", "SUCCESS", 1, 1, "FULL"), "7": ("r1", "SUCCESS", 1, 0, "FULL"), "8": ("r1", "SUCCESS", 0, 0, "FULL")}
    with pytest.raises(DataQualityError):
        run_bronze(spark, landed.withColumn("extract_type", F.lit("daily")), entries, str(tmp_path / "b"), str(tmp_path / "r"))


def test_bronze_load_keeps_codes_as_text(spark, tmp_path):
    landed = pages(spark, ['[{"a":1},{"a":2}]', "oops"]).unionByName(
        spark.createDataFrame([("r1", "7", "full", 1, "/e", '[{"a":3}]'), ("r1", "8", "full", 1, "/e", '[{"a":4}]')], PAGE_SCHEMA)
    )
    entries = catalogue_entries(spark, [{"catmat": "00456"}, {"catmat": "7"}, {"catmat": "8", "ativo": False}, {"nome": "x"}])
    bronze, results = str(tmp_path / "bronze"), str(tmp_path / "results")
    run_bronze(spark, landed, entries, bronze, results)
    read = read_bronze(spark, bronze)
    assert sorted((r["_catmat"], r.a) for r in read.collect()) == [("00456", 1), ("00456", 2), ("7", 3)]
    assert read.filter(F.col("_bronze_object").contains("catmat=00456")).count() == 2
    got = {r.catmat: (r.status, r.records_written, r.error) for r in spark.read.parquet(results).collect()}
    assert got == {"00456": ("FAILED", 2, "NOT_JSON"), "7": ("SUCCESS", 1, None)}


def test_names_of_manifests_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(manifest_source, "_TASK_NAMES", 20)
    rows = spark.range(50).selectExpr("id", """'{"objects":["a","b"]}' AS manifest""")
    found = manifest_objects(rows)
    assert found.count() == 100 and found.rdd.getNumPartitions() == 5
