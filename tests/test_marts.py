from functools import reduce
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from pricegrid.operators.indicators import time_indicators
from pricegrid.operators.marts import monthly_mart, state_mart
from pricegrid.operators.price_index import weighted_index
from pricegrid.operators.quality import (
    eligible_records,
    mart_checks,
    mart_reference_checks,
    preparation_metrics,
    require_mart_columns,
    require_valid_mart,
)
from pricegrid.operators.questions import largest_increases, most_volatile, region_prices, state_differences
from pricegrid.plans.gold import build_marts, run_gold
from pricegrid.settings import DataQualityError, SchemaError, Settings

SILVER = (
    "codigo_item_catalogo string, material_id string, material string, categoria_material string,"
    " unidade_normalizada string, uf string, regiao string, data_compra string, preco_normalizado double,"
    " quantidade double, ni_fornecedor string, codigo_orgao string, is_valid_record boolean, is_outlier boolean"
)


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER).withColumn("data_compra", F.col("data_compra").cast("timestamp"))


def row(price, quantity=1.0, month="2024-01", code="1", uf="SP", supplier="s", buyer="o", valid=True, outlier=False, material="M"):
    return (code, material, "m", None, "kg", uf, "Sudeste", f"{month}-10", price, quantity, supplier, buyer, valid, outlier)


def test_eligibility_and_metrics(spark):
    rows = silver(
        spark,
        [row(1.0), row(0.0), row(1.0, 0.0), row(None), row(1.0, code=None), row(2.0, valid=None), row(3.0, outlier=True), row(4.0, outlier=None), row(5.0, valid=False, outlier=True)],
    )
    assert sorted(r.preco_normalizado for r in eligible_records(rows).collect()) == [1.0, 4.0]
    assert eligible_records(rows, exclude_outliers=False).count() == 3
    m = preparation_metrics(rows).first()
    assert (m.records_input, m.records_valid, m.records_invalid, m.records_outlier_excluded) == (9, 2, 6, 1)


def test_missing_columns_raise(spark):
    with pytest.raises(SchemaError):
        require_mart_columns(spark.createDataFrame([(1,)], "quantidade int"))


@pytest.mark.parametrize("group_rows", [1000, 2, 0])
def test_metrics_per_group(spark, group_rows):
    rows = silver(
        spark,
        [row(10.0, 1.0, supplier="a", buyer="x"), row(20.0, 3.0, supplier="b", buyer="x"), row(40.0, 4.0, supplier=None, buyer="y"), row(7.0, 2.0, code=None)],
    )
    mart = {r.codigo_item_catalogo: r for r in monthly_mart(rows, group_rows).collect()}
    r = mart["1"]
    assert (r.preco_medio, r.preco_mediano, r.preco_minimo, r.preco_maximo) == (pytest.approx(70 / 3), 20.0, 10.0, 40.0)
    assert r.preco_medio_ponderado == pytest.approx(230 / 8)
    assert (r.percentil_25, r.percentil_75) == (15.0, 30.0)
    assert r.desvio_padrao == pytest.approx(stdev([10, 20, 40]))
    assert r.coeficiente_variacao_pct == pytest.approx(100 * stdev([10, 20, 40]) / (70 / 3))
    assert (r.quantidade_compras, r.quantidade_unidades, r.quantidade_fornecedores, r.quantidade_orgaos) == (3, 8.0, 2, 2)
    single = mart[None]
    assert (single.desvio_padrao, single.coeficiente_variacao_pct, single.quantidade_compras) == (None, None, 1)
    assert (r.ano, r.mes, r.ano_mes) == (2024, 1, "2024-01")


def test_absent_columns(spark):
    rows = silver(spark, [row(1.0)]).drop("ni_fornecedor", "codigo_orgao", "categoria_material", "regiao")
    r = state_mart(rows).first()
    assert (r.quantidade_fornecedores, r.quantidade_orgaos, r.categoria_material, r.regiao) == (0, 0, None, None)


def test_every_eligible_row_is_in_one_group(spark):
    rows = silver(spark, [row(float(i % 7 + 1), uf=["SP", None, "RJ"][i % 3], month=f"2024-0{i % 5 + 1}") for i in range(60)])
    assert monthly_mart(rows).agg(F.sum("quantidade_compras")).first()[0] == 60
    assert state_mart(rows, group_rows=3).agg(F.sum("quantidade_compras")).first()[0] == 60


SERIES = "codigo_item_catalogo string, material_id string, unidade_normalizada string, ano_mes string, preco_mediano double"
KEY = ["codigo_item_catalogo", "material_id"]


def series(spark, points, code="1", material="M", unit="kg"):
    return spark.createDataFrame([(code, material, unit, m, p) for m, p in points], SERIES)


def indicators(df, **options):
    return time_indicators(df, KEY, **{"base_period": "2020-01", **options}).orderBy("ano_mes").collect()


def months(n, start=0):
    return [f"{2020 + (start + i) // 12}-{(start + i) % 12 + 1:02d}" for i in range(n)]


def test_changes_and_windows(spark):
    prices = [float(10 + i * i) for i in range(14)]
    got = indicators(series(spark, list(zip(months(14), prices))))
    assert got[0].variacao_mensal_pct is None and got[11].variacao_yoy_pct is None
    assert got[1].variacao_mensal_pct == pytest.approx(10.0)
    assert got[13].variacao_yoy_pct == pytest.approx((prices[13] / prices[1] - 1) * 100)
    assert got[1].media_movel_3m == pytest.approx(10.5) and got[13].media_movel_12m == pytest.approx(sum(prices[2:]) / 12)
    changes = [g.variacao_mensal_pct for g in got]
    assert got[1].volatilidade_6m is None and got[2].volatilidade_6m == pytest.approx(stdev(changes[1:3]))
    assert got[13].volatilidade_6m == pytest.approx(stdev(changes[8:]))
    assert all(g.indice_base_100 == pytest.approx(p * 10) for g, p in zip(got, prices))


def test_lags_count_rows_unless_by_calendar(spark):
    points = [("2020-01", 10.0), ("2020-05", 20.0), ("2020-06", 30.0)]
    assert [g.variacao_mensal_pct for g in indicators(series(spark, points))] == [None, pytest.approx(100.0), pytest.approx(50.0)]
    by_month = indicators(series(spark, points), calendar=True)
    assert [g.variacao_mensal_pct for g in by_month] == [None, None, pytest.approx(50.0)]
    assert [g.media_movel_3m for g in by_month] == [10.0, 20.0, 25.0]


@pytest.mark.parametrize(
    "points, base, period",
    [
        ([("2020-02", None), ("2020-03", 4.0), ("2020-04", 6.0)], 4.0, "2020-03"),
        ([("2020-01", 2.0), ("2020-02", 3.0)], 2.0, "2020-01"),
        ([("2020-01", None), ("2020-02", 3.0)], None, "2020-01"),
        ([("2020-02", None)], None, None),
    ],
)
def test_base_price(spark, points, base, period):
    got = indicators(series(spark, points))
    assert {g.preco_base for g in got} == {base} and {g.periodo_base_utilizado for g in got} == {period}
    if base is None:
        assert {g.indice_base_100 for g in got} == {None}


def test_shocks(spark):
    jump = [10.0] * 10 + [100.0] + [100.0] * 9
    got = indicators(series(spark, list(zip(months(20), jump))))
    assert [i for i, g in enumerate(got) if g.is_price_shock] == [10]
    flat = indicators(series(spark, list(zip(months(5), [3.0] * 5))))
    assert [g.is_price_shock for g in flat] == [False] * 5
    assert [g.is_price_shock for g in indicators(series(spark, [("2020-01", 1.0)]))] == [False]


def test_series_order_and_null_keys(spark):
    rows = series(spark, [("2020-01", 1.0), ("2020-02", 4.0)], unit="kg", material=None).unionByName(
        series(spark, [("2020-01", 2.0)], unit="m", material=None)
    )
    got = {(r.ano_mes, r.unidade_normalizada): r.variacao_mensal_pct for r in time_indicators(rows, KEY).collect()}
    assert got == {("2020-01", "kg"): None, ("2020-01", "m"): pytest.approx(100.0), ("2020-02", "kg"): pytest.approx(100.0)}


def test_windows_share_one_shuffle(spark):
    rows = series(spark, [("2020-01", 1.0)])
    plan = time_indicators(rows, KEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange") == 1


@pytest.mark.parametrize("calendar", [False, True])
def test_long_series_give_the_same(spark, calendar):
    """Three units per month, gaps, null prices and a null key."""
    points = [(m, None if i % 7 == 3 else 10.0 + (i * i) % 13) for i, m in enumerate(months(40)) if i % 11]
    rows = reduce(
        lambda a, b: a.unionByName(b),
        [series(spark, points, unit=u, material=k) for k in ("M", None) for u in ("kg", None, "m")] + [series(spark, points[:3], code="2")],
    ).repartition(3)
    held = time_indicators(rows, KEY, "2020-05", calendar=calendar)
    cut = time_indicators(rows, KEY, "2020-05", calendar=calendar, series_rows=50, run_rows=15)
    order = ["codigo_item_catalogo", "material_id", "unidade_normalizada", "ano_mes"]
    left, right = (df.orderBy(*order).collect() for df in (held, cut.select(*held.columns)))
    assert len(left) == len(right) == len(points) * 6 + 3
    for a, b in zip(left, right):
        for name in held.columns:
            assert b[name] == (pytest.approx(a[name], rel=1e-9) if isinstance(a[name], float) else a[name]), (name, a, b)


def test_mart_checks(spark):
    mart = monthly_mart(silver(spark, [row(1.0)]))
    checks = mart_checks(mart).first().asDict()
    require_valid_mart("t", checks)
    with pytest.raises(DataQualityError):
        require_valid_mart("t", {**checks, "records": 0})
    bad = mart.withColumn("preco_mediano", F.lit(-1.0)).withColumn("ano_mes", F.lit(None).cast("string"))
    with pytest.raises(DataQualityError):
        require_valid_mart("t", mart_checks(bad).first().asDict())


def test_reference_checks(spark):
    mart = monthly_mart(silver(spark, [row(1.0), row(1.0, month="2019-01"), row(1.0, material="X", code="2"), row(1.0, material=None, code="3")]))
    known = spark.createDataFrame([("M",)], "material_id string")
    r = mart_reference_checks(mart, known, 2020).first()
    assert (r.records, r.years_before_start, r.invalid_material_ids) == (4, 1, 2)


def test_weighted_index(spark):
    rows = spark.createDataFrame(
        [("A", "2020-01", 100.0), ("B", "2020-01", 200.0), ("C", "2020-01", 900.0), ("A", "2020-02", None)],
        "material_id string, ano_mes string, indice_base_100 double",
    )
    weights = spark.createDataFrame([("A", 3.0), ("B", 1.0)], "material_id string, peso double")
    got = [(r.ano_mes, r.indice_ponderado, r.observacoes) for r in weighted_index(rows, weights).collect()]
    assert got == [("2020-01", 125.0, 2)]


def test_questions(spark):
    rows = silver(
        spark,
        [row(p, month=f"2024-{m:02d}", code=c, uf=u, material="M" + c) for c, f in (("1", 1.0), ("2", 3.0)) for m, p in ((1, 10.0), (2, 10.0 + f), (3, 9.0 * f)) for u in ("SP", "RJ")],
    )
    marts = build_marts(rows, Settings(base_period="2024-01"))
    assert [r.codigo_item_catalogo for r in most_volatile(marts.monthly, KEY, top=1).collect()] == ["2"]
    top = largest_increases(marts.monthly, KEY, "2024-01", "2024-03").collect()
    assert [(r.codigo_item_catalogo, round(r.aumento_pct)) for r in top] == [("2", 170), ("1", -10)]
    assert state_differences(marts.state, marts.monthly).filter("diferenca_pct = 0").count() == 12
    assert region_prices(marts.state).filter("round(indice_pais_100, 6) = 100").count() == 6


def test_gold_needs_valid_records(spark, tmp_path):
    path = str(tmp_path / "s")
    silver(spark, [row(0.0)]).withColumns({"ano": F.lit(2024), "mes": F.lit(1)}).write.partitionBy("ano", "mes").parquet(path)
    with pytest.raises(DataQualityError):
        run_gold(spark, path, str(tmp_path / "g"))
