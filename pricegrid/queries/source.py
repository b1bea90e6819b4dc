"""The driver tables as purchases, in one definition for both engines.

``lineitem`` with its order, part and supplier is one purchased item. Column
expressions are written in the SQL that Spark and DuckDB share, so the Spark
queries and their twins start from the same rows. Some values are spoiled by
fixed rules, because the tables themselves are clean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.catalogue import ENTRY_SCHEMA

START_DATE = "1996-01-01"
BASE_PERIOD = "1996-01"
START_YEAR = 1996

# A federative unit for each nation key, in key order.
UF_BY_NATION = "AC,AP,AM,PA,RO,RR,TO,AL,BA,CE,MA,PB,PE,PI,RN,SE,DF,GO,MT,MS,ES,MG,RJ,SP,PR"

_UF = f"split_part('{UF_BY_NATION}', ',', CAST(s_nationkey AS INT) + 1)"

# The divisor makes prices that are not round decimals, so that rounding a result
# never meets a tie, which engines break in different ways.
_PRICE = "(l_extendedprice / l_quantity / 1.04729E0)"

# Canonical column -> (table besides lineitem, expression).
PURCHASE = {
    "id_compra": ("", "CAST(l_orderkey AS STRING)"),
    "id_item_compra": ("", "CAST(l_linenumber AS STRING)"),
    "codigo_item_catalogo": (
        "part",
        "CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE replace(p_brand, 'Brand#', '') END",
    ),
    "tipo": ("part", "p_type"),
    "descricao_item": ("part", "CASE WHEN l_orderkey % 59 = 0 THEN NULL ELSE p_name END"),
    "unidade_original": ("part", "CASE WHEN p_size <= 25 THEN 'kg' ELSE 'un' END"),
    "quantidade": ("", "CASE WHEN l_orderkey % 79 = 0 THEN 0.0E0 ELSE l_quantity END"),
    "preco_unitario": (
        "",
        f"CASE WHEN l_orderkey % 89 = 0 THEN -{_PRICE}"
        f" WHEN l_orderkey % 37 = 0 THEN {_PRICE} * 20 ELSE {_PRICE} END",
    ),
    "data_compra": (
        "",
        "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) END",
    ),
    "uf": (
        "supplier",
        f"CASE WHEN l_orderkey % 83 = 0 THEN 'ZZ' WHEN l_orderkey % 71 = 0 THEN NULL ELSE {_UF} END",
    ),
    "codigo_orgao": ("orders", "CAST(o_custkey AS STRING)"),
    "ni_fornecedor": (
        "",
        "CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END",
    ),
    "record_hash": (
        "",
        "CASE WHEN l_orderkey % 101 = 0 THEN NULL"
        " ELSE concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END",
    ),
    "arrival": ("", "l_partkey * 1000000 + l_suppkey"),
    "update_days": ("", "CAST(l_linenumber AS BIGINT)"),
}

_KEYS = {
    "part": ("l_partkey", "p_partkey"),
    "orders": ("l_orderkey", "o_orderkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
}


# Parts of the expressions that one row of a joined table decides. Spark works them out
# there, before the join repeats that row.
_BEFORE_JOIN = {
    "part": {
        "replace(p_brand, 'Brand#', '')": "p_code",
        "CASE WHEN p_size <= 25 THEN 'kg' ELSE 'un' END": "p_unit",
    },
    "orders": {"CAST(o_custkey AS STRING)": "o_customer"},
    "supplier": {_UF: "s_uf"},
}


# The tables' columns, so that no job has to read them from the files.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, dealt over the cores as its files and row groups allow."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _tables(columns: Sequence[str]) -> list[str]:
    wanted = {PURCHASE[c][0] for c in columns}
    return [t for t in _KEYS if t in wanted]


def purchases(spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(PURCHASE)) -> DataFrame:
    """Purchases with the given columns; only the tables they need are read."""
    rows = table(spark, sf_dir, "lineitem")
    # Parts come last: their texts are then not shuffled with the other joins' rows.
    chosen = {c: PURCHASE[c][1] for c in columns}
    for name in sorted(_tables(columns), key=lambda t: t == "part"):
        left, right = _KEYS[name]
        known = _BEFORE_JOIN[name]
        side = table(spark, sf_dir, name).withColumns({n: F.expr(e) for e, n in known.items()})
        rows = rows.join(side, F.col(left) == F.col(right))
        for e, n in known.items():
            chosen = {c: text.replace(e, n) for c, text in chosen.items()}
    return rows.select(*[F.expr(text).alias(c) for c, text in chosen.items()])


def purchases_sql(columns: Sequence[str] = tuple(PURCHASE)) -> str:
    joins = " ".join(f"JOIN {t} ON {_KEYS[t][0]} = {_KEYS[t][1]}" for t in _tables(columns))
    chosen = ", ".join(f"{PURCHASE[c][1]} AS {c}" for c in columns)
    return f"SELECT {chosen} FROM lineitem {joins}"


# Each part is a catalogue entry of its brand's code; later parts win.
ENTRY = {
    "position": "p_partkey",
    "material_id": "concat('M-', replace(p_brand, 'Brand#', ''))",
    "nome": "p_name",
    "categoria": "p_type",
    "catmat": "CASE WHEN p_brand IN ('Brand#24', 'Brand#25') THEN NULL"
    " ELSE concat(replace(p_brand, 'Brand#', ''), '.0') END",
    "unidade_padrao": "CASE WHEN p_size % 2 = 0 THEN 'kg' END",
    "ativo": "p_size <> 13",
}


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue list, derived from ``part``."""
    rows = table(spark, sf_dir, "part").select(*[F.expr(e).alias(n) for n, e in ENTRY.items()])
    return rows.select(
        *[
            (F.col(f.name) if f.name in ENTRY else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ENTRY_SCHEMA.fields
        ]
    )


def mapping_sql() -> str:
    chosen = ", ".join(f"{e} AS {n}" for n, e in ENTRY.items())
    return (
        "SELECT CAST(replace(catmat, '.0', '') AS STRING) AS codigo_item_catalogo, material_id,"
        " nome AS material, categoria AS categoria_material, unidade_padrao"
        f" FROM (SELECT {chosen} FROM part) WHERE ativo AND catmat IS NOT NULL"
        " QUALIFY row_number() OVER (PARTITION BY catmat ORDER BY position DESC) = 1"
    )
