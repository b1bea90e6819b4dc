from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricegrid.operators.canonical import canonical_columns, canonical_records
from pricegrid.operators.catalogue import catalogue_entries, catalogue_mapping
from pricegrid.operators.dedup import dedup_keys, deduplicate
from pricegrid.operators.derive import derived_columns
from pricegrid.operators.joins import attach_dimension, attach_groups, require_unique
from pricegrid.operators.outliers import iqr_outliers, percentile_outliers
from pricegrid.operators.periods import within_period
from pricegrid.operators.quality import quality_flags, silver_checks
from pricegrid.operators.quantiles import group_quantiles, value_band
from pricegrid.operators.units import convert_units
from pricegrid.plans.silver import transform_silver
from pricegrid.settings import DataQualityError


def test_alias_order_and_missing_columns(spark):
    rows = spark.createDataFrame(
        [("SP", "RJ", "kg", "KG")], "estado string, uf string, nomeUnidadeMedida string, siglaUnidadeMedida string"
    )
    row = canonical_columns(rows).first()
    assert (row.uf, row.unidade_original, row.poder) == ("SP", "kg", None)
    assert row.estado == "SP" and row.nome_unidade_medida == "kg"


def test_types(spark):
    rows = spark.createDataFrame(
        [(" sp ", "1.234,56", 2.5, "2024-03-01T23:00:00-03:00", "123.0")],
        "estado string, precoUnitario string, quantidade double, dataCompra string, codigoItemCatalogo string",
    )
    row = canonical_records(rows).first()
    assert (row.uf, row.preco_unitario, row.quantidade) == ("SP", 1234.56, 2.5)
    assert row.data_compra == datetime(2024, 3, 2, 2) and row.codigo_item_catalogo == "123"


def test_period_keeps_missing_dates(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1, timestamp'2019-12-31'), (2, timestamp'2020-01-01'), (3, null) AS t(i, data_compra)"
    )
    assert sorted(r.i for r in within_period(rows, "2020-01-01").collect()) == [2, 3]


DEDUP = "record_hash string, id_compra string, id_item_compra string, codigo_item_catalogo string, ingestion_timestamp string, v int"


def test_dedup_by_hash_takes_nulls_as_one_group(spark):
    rows = spark.createDataFrame(
        [("a", "1", "1", "c", "2024-01-01", 1), ("a", "1", "1", "c", "2024-01-02", 2), (None, "2", "1", "c", "2024-01-01", 3), (None, "3", "1", "c", "2024-01-03", 4)],
        DEDUP,
    )
    assert dedup_keys(rows) == ["record_hash"]
    assert sorted(r.v for r in deduplicate(rows).collect()) == [2, 4]
    assert sorted(r.v for r in deduplicate(rows, null_hash="keep").collect()) == [2, 3, 4]


def test_dedup_by_the_key_parts_in_use(spark):
    rows = spark.createDataFrame(
        [(None, "1", None, "c", "2024-01-01", 1), (None, "1", None, "c", "2024-01-02", 2), (None, "1", None, "d", "2024-01-02", 3)],
        DEDUP,
    )
    assert dedup_keys(rows) == ["id_compra", "codigo_item_catalogo"]
    assert sorted(r.v for r in deduplicate(rows).collect()) == [2, 3]


def test_dedup_of_whole_rows(spark):
    rows = spark.createDataFrame([(None, None, None, None, "x", 1)] * 3 + [(None, None, None, None, "x", 2)], DEDUP)
    assert dedup_keys(rows) == []
    assert sorted(r.v for r in deduplicate(rows).collect()) == [1, 2]


def test_dedup_limits_before_the_shuffle(spark):
    rows = spark.createDataFrame([("a", "1", "1", "c", "x", 1)], DEDUP)
    plan = deduplicate(rows, keys=["record_hash"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def flagged(spark, rows):
    return spark.createDataFrame(
        rows,
        "codigo_item_catalogo string, data_compra string, preco_unitario double, quantidade double, uf string,"
        " unidade_padrao string, unidade_original string",
    ).withColumn("data_compra", F.col("data_compra").cast("timestamp"))


def test_derived_columns(spark):
    rows = flagged(spark, [("1", "2024-06-30", 2.0, 3.0, "SP", None, "kg"), ("1", "2024-07-01", 2.0, None, "ZZ", "m3", "kg"), ("1", None, 1.0, 1.0, None, None, None)])
    got = [
        (r.ano, r.mes, r.ano_mes, r.trimestre, r.semestre, r.regiao, r.valor_total_item, r.unidade_normalizada)
        for r in derived_columns(rows).collect()
    ]
    assert got == [
        (2024, 6, "2024-06", "2024Q2", "2024-S1", "Sudeste", 6.0, "kg"),
        (2024, 7, "2024-07", "2024Q3", "2024-S2", None, None, "m3"),
        (None, None, None, None, None, None, 1.0, None),
    ]


def test_quality_flags(spark):
    rows = flagged(
        spark,
        [
            ("1", "2024-01-01", 1.0, 1.0, None, None, None),
            ("", None, 0.0, -1.0, "", None, None),
            (None, "2024-01-01", None, 1.0, "ZZ", None, None),
        ],
    )
    got = [(r.is_valid_record, r.quality_issues) for r in quality_flags(rows).collect()]
    assert got == [
        (True, None),
        (False, "CATMAT_INVALIDO;DATA_COMPRA_INVALIDA;PRECO_INVALIDO;QUANTIDADE_INVALIDA;UF_INVALIDA"),
        (False, "CATMAT_INVALIDO;PRECO_INVALIDO;UF_INVALIDA"),
    ]


def test_silver_checks(spark):
    rows = spark.createDataFrame(
        [("1", "1", "c", "x"), ("1", "1", "c", None), ("2", "1", "c", "y")],
        "id_compra string, id_item_compra string, codigo_item_catalogo string, descricao_item string",
    )
    row = silver_checks(rows).first()
    assert (row.records, row.duplicate_technical_keys, row.null_descriptions) == (3, 1, 1)


def priced(spark):
    groups = {
        "nine": [10.0] * 8 + [1000.0],
        "ten": [10.0, 11, 12, 13, 14, 15, 16, 17, 18, 1000],
        "flat": [5.0] * 9 + [500.0],
        "negative": [-400.0, 10, 11, 12, 13, 14, 15, 16, 17, 18],
        None: [10.0, 11, 12, 13, 14, 15, 16, 17, 18, 1000],
    }
    rows = [(c, "2024-01", float(p)) for c, ps in groups.items() for p in ps] + [("ten", "2024-01", None)]
    return spark.createDataFrame(rows, "codigo_item_catalogo string, ano_mes string, preco_normalizado double")


# Sizes: all groups held in a task, some, and none of them.
@pytest.mark.parametrize("group_rows, broadcast_rows", [(1000, 1000), (10, 0), (0, 0)])
def test_iqr_outliers(spark, group_rows, broadcast_rows):
    got = iqr_outliers(priced(spark), group_rows=group_rows, broadcast_rows=broadcast_rows)
    assert got.count() == 50
    marked = got.filter("is_outlier").collect()
    assert sorted((r.codigo_item_catalogo, r.preco_normalizado, r.outlier_reason) for r in marked) == [
        ("negative", -400.0, "IQR_1.5"), ("ten", 1000.0, "IQR_1.5"),
    ]
    assert got.filter("is_outlier IS NULL OR (NOT is_outlier AND outlier_reason IS NOT NULL)").count() == 0


def test_percentile_outliers(spark):
    got = percentile_outliers(priced(spark)).filter("is_outlier AND codigo_item_catalogo = 'ten'").collect()
    assert sorted(r.preco_normalizado for r in got) == [10.0, 1000.0]


@pytest.mark.parametrize("group_rows", [10**6, 100, 0])
def test_quantiles_match_numpy(spark, group_rows):
    """One group has most of the rows; values repeat, are negative, tiny and huge."""
    random = np.random.default_rng(7)
    values = {
        "hot": np.concatenate([random.normal(0, 50, 3000).round(1), random.lognormal(3, 4, 3000), [0.0] * 500]),
        "small": random.normal(100, 1e-6, 60),
        "one": np.array([-3.5]),
    }
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("none", None), (None, 1.0), (None, 2.0)]
    table = spark.createDataFrame(rows, "k string, v double")
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    solved, groups = group_quantiles(table, ["k"], "v", probs, group_rows)
    got = {r.k: (r.group_rows, r.quantiles) for r in solved.collect()}
    assert groups == 5 and len(got) == 5
    assert got["none"] == (0, None) and got[None] == (2, [1.0, 1.01, 1.25, 1.5, 1.75, 1.999, 2.0])
    for k, vs in values.items():
        assert got[k][0] == len(vs)
        np.testing.assert_allclose(got[k][1], np.quantile(vs, probs), rtol=1e-12, atol=1e-12)


def test_bands_keep_the_order(spark):
    values = sorted([-1e300, -5.0, -1e-300, 0.0, 5e-324, 1e-9, 1.0, 1.0000001, 2.0, 1e300])
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(value_band(F.col("v")).alias("b"))
    bands = [r.b for r in rows.collect()]
    assert bands == sorted(bands)


@pytest.mark.parametrize("bound", [100, 0])
def test_group_join_keeps_every_row(spark, bound):
    rows = spark.createDataFrame([(i % 3 if i % 4 else None, i) for i in range(60)], "k int, i int")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("m"))
    got = attach_groups(rows, groups, ["k"], 4, "n", bound)
    expected = {r.k: r.m for r in groups.collect()}
    assert got.columns == ["k", "i", "m"] and got.count() == 60
    assert all(r.m == expected[r.k] for r in got.collect())


def test_hot_groups_spread_and_cold_ones_join(spark, monkeypatch):
    monkeypatch.setattr("pricegrid.operators.joins.SPREAD", 4)
    rows = spark.createDataFrame([("hot", i) for i in range(50)] + [("a", 1), ("b", 2), (None, 3)], "k string, i int")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("m"))
    got = {(r.k, r.m) for r in attach_groups(rows, groups, ["k"], 4, "n", 0).collect()}
    assert got == {("hot", 49), ("a", 1), ("b", 2), (None, 3)}


def test_large_dimension_keeps_unknown_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "k string, i int")
    dimension = spark.createDataFrame([("a", 10), ("b", 20), (None, 30)], "k string, d int")
    for bound in (100, 1):
        got = attach_dimension(rows, dimension, "k", broadcast_rows=bound)
        assert sorted((r.i, r.d) for r in got.collect()) == [(1, 10), (2, None), (3, None)]


def test_repeated_keys_raise(spark):
    with pytest.raises(DataQualityError):
        require_unique(spark.createDataFrame([("a",), ("a",)], "k string"), ["k"])
    require_unique(spark.createDataFrame([("a",), ("b",)], "k string"), ["k"])


def test_unit_conversion(spark):
    rows = spark.createDataFrame(
        [(1, "SC", "kg", 100.0), (2, "kg", "kg", 3.0), (3, "L", "kg", 4.0), (4, None, "kg", 5.0), (5, "L", None, 6.0)],
        "i int, unidade_original string, unidade_padrao string, preco_unitario double",
    )
    rules = spark.createDataFrame([("sc", "KG", 50.0)], "de string, para string, fator double")
    got = {r.i: (r.preco_normalizado, r.unidade_normalizada, r.conversao_desconhecida) for r in convert_units(rows, rules).collect()}
    assert got == {1: (2.0, "kg", False), 2: (3.0, "kg", False), 3: (4.0, "L", True), 4: (5.0, "kg", False), 5: (6.0, "L", False)}


def test_silver_writes_only_columns_that_are_read(spark):
    raw = spark.createDataFrame(
        [("1", "10,5", "2", "2024-01-02", "kg", "h")],
        "codigoItemCatalogo string, precoUnitario string, quantidade string, dataCompra string,"
        " nomeUnidadeMedida string, _record_hash string",
    )
    mapping = catalogue_mapping(catalogue_entries(spark, [{"catmat": "1", "material_id": "M"}]))
    whole = transform_silver(raw, mapping).records
    some = transform_silver(raw, mapping, columns=("quantidade",)).records
    assert set(some.columns) == {
        "quantidade", "codigo_item_catalogo", "ano_mes", "preco_normalizado", "is_valid_record",
        "is_outlier", "outlier_reason",
    }
    assert some.collect() == whole.select(*some.columns).collect()
