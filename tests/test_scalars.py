from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pricegrid.functions.names import rename_snake_case, snake_case, snake_case_values
from pricegrid.functions.scalars import WHITESPACE, catalogue_code, local_number, strip, utc_timestamp
from pricegrid.queries.registry import rounded_value
from pricegrid.settings import SchemaError


@pytest.mark.parametrize(
    "name, expected",
    [
        ("codigoItemCatalogo", "codigo_item_catalogo"),
        ("_recordHash", "_record_hash"),
        ("  Nome do Órgão ", "nome_do_rg_o"),
        ("__a--B__c__", "_a_b_c"),
        ("CNPJ", "cnpj"),
        ("a1B2C", "a1_b2_c"),
        ("orgao__codigo", "orgao_codigo"),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_snake_case_values_follow_the_same_rule(spark):
    names = ["codigoItemCatalogo", "_recordHash", "__a--B__c__", "CNPJ", "a1B2C", "x"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.s for r in rows.select("n", snake_case_values(F.col("n")).alias("s")).collect()}
    assert got == {n: snake_case(n) for n in names}


def test_colliding_names_raise(spark):
    with pytest.raises(SchemaError):
        rename_snake_case(spark.createDataFrame([(1, 2)], "precoUnitario int, preco_unitario int"))


def _one(spark, values, dtype, function):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    kind = rows.schema["v"].dataType
    return [r[0] for r in rows.select(function(F.col("v"), kind).alias("x"), "i").orderBy("i").collect()]


def test_codes(spark):
    got = _one(spark, ["123", "123.0", " 45 ", "\t7 ", "", ".0", None], "string", catalogue_code)
    assert got == ["123", "123", "45", "7", None, None, None]
    assert _one(spark, [123.0, 1e9, float("nan"), None], "double", catalogue_code) == [
        "123", "1000000000", None, None,
    ]


def test_local_numbers(spark):
    texts = ["10", "1.234,56", "12.50", "R$ 5", "", "-1", " 7,5 ", "1,2,3", "NaN", "5d", None]
    assert _one(spark, texts, "string", local_number) == [
        10.0, 1234.56, 1250.0, None, None, -1.0, 7.5, None, None, None, None,
    ]
    assert _one(spark, [12.5, float("nan")], "double", local_number) == [12.5, None]
    assert _one(spark, [3], "int", local_number) == [3.0]


def test_white_space_of_any_kind_is_trimmed(spark):
    texts = [f"{a}{b}{c}" for a in ("", " ", "\t ", " \u00a0", "\u3000") for b in ("x", "é a", "~", "ã", "")
             for c in ("", " ", "\n", " \x1f ", "\u2028")] + list(WHITESPACE) + [None]
    got = _one(spark, texts, "string", lambda col, kind: strip(col))
    assert got == [None if t is None else t.strip() for t in texts]


def test_a_number_is_worked_out_once(spark):
    # Text was mapped character by character, and worked out twice for the check and the cast.
    rows = spark.createDataFrame([(" 1.234,5 ",)], "v string")
    typed = rows.select(local_number(F.col("v"), rows.schema["v"].dataType).alias("x"))
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert "translate" not in plan.lower() and plan.lower().count("cast(") == 1
    assert typed.first()[0] == 1234.5


def test_values_are_rounded_without_decimal_text(spark):
    values = [1.00005, -1.00005, 0.00004, -0.00004, 2.5, 1e10 + 0.12345, -3e11 - 0.5, 1e300, float("inf"), None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for r in rows.select("v", rounded_value(F.col("v")).alias("x"), (F.round("v", 4) + F.lit(0.0)).alias("y")).collect():
        assert r.x == r.y and str(r.x) == str(r.y)
    nan = spark.range(1).select(rounded_value(F.lit(float("nan"))).alias("x")).first()[0]
    assert nan != nan


def test_timestamps_are_utc(spark):
    texts = ["2024-05-01", "2024-05-01T10:00:00-03:00", "20240501", "bad", "10:30:00", None]
    assert _one(spark, texts, "string", utc_timestamp) == [
        datetime(2024, 5, 1), datetime(2024, 5, 1, 13), datetime(2024, 5, 1), None, None, None,
    ]
