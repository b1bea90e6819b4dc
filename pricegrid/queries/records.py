"""Queries over single purchases: typing, enrichment, dedup, flags, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import REGION_BY_UF
from ..operators.canonical import canonical_records
from ..operators.catalogue import catalogue_mapping, enrich
from ..operators.dedup import deduplicate
from ..operators.derive import derived_columns
from ..operators.dimensions import date_dimension, eligible_materials, material_dimension
from ..operators.outliers import iqr_outliers, percentile_outliers
from ..operators.periods import period_counts, within_period
from ..operators.quality import quality_flags, silver_checks
from ..operators.quantiles import group_quantiles
from ..operators.units import convert_units
from ..plans.silver import SilverResult, transform_silver
from ..settings import Settings
from ..staging import stage
from .registry import DIGITS, comparable, query, rounded
from .source import PURCHASE, START_DATE, entries, mapping_sql, purchases, purchases_sql, table

SETTINGS = Settings(start_date=START_DATE, base_period=START_DATE[:7])
_ID = ("id_compra", "id_item_compra", "arrival")
_PLAIN = tuple(c for c in PURCHASE if c not in ("update_days", "tipo"))

_REGION = " ".join(f"WHEN '{uf}' THEN '{region}'" for uf, region in REGION_BY_UF.items())
_UFS = ", ".join(f"'{uf}'" for uf in REGION_BY_UF)


def flagged_sql(source: str = "p") -> str:
    """CTEs ending in ``f``: enriched, derived and flagged purchases."""
    return f"""p AS ({purchases_sql(_PLAIN)}), m AS ({mapping_sql()}),
    d AS (SELECT q.*, material_id, material, categoria_material, unidade_padrao
      FROM {source} q LEFT JOIN m ON q.codigo_item_catalogo = m.codigo_item_catalogo
      WHERE data_compra IS NULL OR data_compra >= TIMESTAMP '{START_DATE}'),
    v AS (SELECT *, quantidade * preco_unitario AS valor_total_item,
      year(data_compra) AS ano, month(data_compra) AS mes,
      strftime(data_compra, '%Y-%m') AS ano_mes,
      year(data_compra) || 'Q' || quarter(data_compra) AS trimestre,
      year(data_compra) || CASE WHEN month(data_compra) <= 6 THEN '-S1' ELSE '-S2' END AS semestre,
      CASE uf {_REGION} END AS regiao, preco_unitario AS preco_normalizado,
      coalesce(unidade_padrao, unidade_original) AS unidade_normalizada,
      coalesce(codigo_item_catalogo <> '', false) AS is_valid_catmat,
      data_compra IS NOT NULL AS is_valid_date,
      coalesce(preco_unitario > 0, false) AS is_valid_price,
      coalesce(quantidade > 0, false) AS is_valid_quantity,
      (uf IS NULL OR uf IN ({_UFS})) AS is_valid_uf FROM d),
    f AS (SELECT *, (is_valid_catmat AND is_valid_date AND is_valid_price AND is_valid_quantity
        AND is_valid_uf) AS is_valid_record,
      nullif(concat_ws(';', CASE WHEN NOT is_valid_catmat THEN 'CATMAT_INVALIDO' END,
        CASE WHEN NOT is_valid_date THEN 'DATA_COMPRA_INVALIDA' END,
        CASE WHEN NOT is_valid_price THEN 'PRECO_INVALIDO' END,
        CASE WHEN NOT is_valid_quantity THEN 'QUANTIDADE_INVALIDA' END,
        CASE WHEN NOT is_valid_uf THEN 'UF_INVALIDA' END), '') AS quality_issues FROM v)"""


def outliers_sql(source: str, low: float, high: float, outside: str, reason: str) -> str:
    """CTEs ending in ``o``: ``source`` with outlier columns."""
    return f"""l AS (SELECT codigo_item_catalogo AS lc, ano_mes AS lm, count(preco_normalizado) AS n,
      quantile_cont(preco_normalizado, {low}) AS q1, quantile_cont(preco_normalizado, {high}) AS q3
      FROM {source} GROUP BY ALL),
    o AS (SELECT {source}.*, coalesce(n >= 10 AND ({outside}), false) AS is_outlier,
      CASE WHEN coalesce(n >= 10 AND ({outside}), false) THEN '{reason}' END AS outlier_reason
      FROM {source} LEFT JOIN l ON codigo_item_catalogo = lc AND ano_mes = lm)"""


IQR_OUTSIDE = (
    "q3 - q1 > 0 AND (preco_normalizado < q1 - 1.5e0 * (q3 - q1)"
    " OR preco_normalizado > q3 + 1.5e0 * (q3 - q1))"
)
IQR_SQL = outliers_sql("f", 0.25, 0.75, IQR_OUTSIDE, "IQR_1.5")


def flagged_purchases(spark: SparkSession, sf_dir: str, staged: bool = False) -> DataFrame:
    """Purchases of the period with catalogue, derived and quality columns. ``staged``
    writes them first, without the columns that follow from others, to be read again."""
    rows = within_period(purchases(spark, sf_dir, _PLAIN), START_DATE)
    if staged:
        rows = stage(rows, "purchases")
    mapping = stage(catalogue_mapping(entries(spark, sf_dir)), "mapping")
    return quality_flags(derived_columns(enrich(rows, mapping)))


# What outliers and marts need of a record.
MART_INPUT = (
    "id_compra", "id_item_compra", "arrival", "codigo_item_catalogo", "material_id", "material",
    "categoria_material", "unidade_padrao", "unidade_normalizada", "uf", "regiao", "data_compra",
    "ano_mes", "quantidade", "preco_normalizado", "ni_fornecedor", "codigo_orgao", "is_valid_record",
)


# What the marts alone read of it.
MART_COLUMNS = tuple(
    c for c in MART_INPUT if c not in ("id_compra", "id_item_compra", "arrival", "unidade_padrao")
)


def cleaned_purchases(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = MART_INPUT
) -> DataFrame:
    """The same as a written table, as outliers read it more than once."""
    return stage(flagged_purchases(spark, sf_dir).select(*columns), "purchases")


# Source records as they land: camelCase names, everything is text.
_NUMBER_TEXT = "replace(CAST({} AS STRING), '.', ',')"
RAW = {
    "codigoItemCatalogo": "CASE WHEN CAST(id_item_compra AS INT) % 2 = 0"
    " THEN ' ' || codigo_item_catalogo || '.0 ' ELSE codigo_item_catalogo END",
    "descricaoItem": "'  ' || descricao_item || ' '",
    "nomeUnidadeMedida": "unidade_original || ' '",
    "siglaUnidadeMedida": "'?'",
    "quantidade": "CASE WHEN CAST(id_item_compra AS INT) = 3 THEN 'n/d'"
    f" ELSE {_NUMBER_TEXT.format('quantidade')} END",
    "precoUnitario": f"' ' || {_NUMBER_TEXT.format('preco_unitario')}",
    "dataCompra": "CASE WHEN data_compra IS NULL THEN 'bad'"
    " WHEN CAST(id_item_compra AS INT) % 2 = 0"
    " THEN concat(substring(CAST(data_compra AS STRING), 1, 10), 'T21:30:00-03:00')"
    " ELSE substring(CAST(data_compra AS STRING), 1, 10) END",
    "uf": "'XX'",
    "estado": "' ' || lower(uf)",
    "codigoOrgao": "codigo_orgao",
    "niFornecedor": "ni_fornecedor",
    "idCompra": "id_compra",
    "idItemCompra": "id_item_compra",
    "_record_hash": "record_hash",
}


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases(spark, sf_dir, _PLAIN)
    stamp = F.timestamp_micros(F.col("arrival")).cast("timestamp_ntz").cast("string")
    return rows.select(
        *[F.expr(e).alias(n) for n, e in RAW.items()],
        stamp.alias("_ingestion_timestamp"),
    )


def raw_sql() -> str:
    chosen = ", ".join(f"{e} AS {n}" for n, e in RAW.items())
    return f"SELECT {chosen}, arrival FROM ({purchases_sql(_PLAIN)})"


_DECIMAL = "TRY_CAST(replace(replace(trim({}), '.', ''), ',', '.') AS DOUBLE)"
CANONICAL_SQL = f"""raw AS ({raw_sql()}),
    c AS (SELECT nullif(regexp_replace(trim(codigoItemCatalogo), '\\.0$', ''), '')
        AS codigo_item_catalogo,
      trim(descricaoItem) AS descricao_item, trim(nomeUnidadeMedida) AS unidade_original,
      {_DECIMAL.format('quantidade')} AS quantidade,
      {_DECIMAL.format('precoUnitario')} AS preco_unitario,
      CASE WHEN dataCompra = 'bad' THEN NULL
        WHEN contains(dataCompra, 'T') THEN CAST(substring(dataCompra, 1, 10) AS TIMESTAMP)
          + INTERVAL '1 day 30 minutes'
        ELSE CAST(dataCompra AS TIMESTAMP) END AS data_compra,
      upper(trim(estado)) AS uf, codigoOrgao AS codigo_orgao, niFornecedor AS ni_fornecedor,
      idCompra AS id_compra, idItemCompra AS id_item_compra, _record_hash AS record_hash,
      arrival FROM raw)"""

_CANONICAL = (
    "codigo_item_catalogo", "descricao_item", "unidade_original", "quantidade", "preco_unitario",
    "data_compra", "uf", "codigo_orgao", "ni_fornecedor", "id_compra", "id_item_compra",
    "record_hash",
)


@query(
    "canonical_records",
    f"""WITH {CANONICAL_SQL} SELECT codigo_item_catalogo, descricao_item, unidade_original,
    {rounded('quantidade', 'preco_unitario')}, data_compra, uf, codigo_orgao, ni_fornecedor,
    id_compra, id_item_compra, record_hash, CAST(NULL AS VARCHAR) AS poder FROM c""",
)
def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(canonical_records(raw_records(spark, sf_dir)).select(*_CANONICAL, "poder"))


@query(
    "period_counts",
    f"""WITH p AS ({purchases_sql(('data_compra',))}), k AS (SELECT data_compra IS NULL
      OR data_compra >= TIMESTAMP '{START_DATE}' AS kept FROM p)
    SELECT count(*) AS records_input, count(*) FILTER (WHERE kept) AS records_kept,
    count(*) - count(*) FILTER (WHERE kept) AS records_removed FROM k""",
)
def period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_counts(purchases(spark, sf_dir, ("data_compra",)), START_DATE)


@query("catalogue_mapping", mapping_sql())
def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue_mapping(entries(spark, sf_dir))


_ENRICHED = (*_ID, "codigo_item_catalogo", "material_id", "material", "categoria_material", "unidade_padrao")


@query("enriched_purchases", f"WITH {flagged_sql()} SELECT {', '.join(_ENRICHED)} FROM d")
def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases(spark, sf_dir, (*_ID, "codigo_item_catalogo", "data_compra"))
    return enrich(
        within_period(rows, START_DATE), catalogue_mapping(entries(spark, sf_dir))
    ).select(*_ENRICHED)


@query(
    "unmatched_catalogue",
    f"""WITH p AS ({purchases_sql((*_ID, 'codigo_item_catalogo', 'descricao_item'))})
    SELECT {', '.join(_ID)}, codigo_item_catalogo AS material_id, descricao_item AS material,
    CAST(NULL AS VARCHAR) AS unidade_padrao FROM p""",
)
def without_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With no active entry, codes and descriptions stand in for materials."""
    rows = purchases(spark, sf_dir, (*_ID, "codigo_item_catalogo", "descricao_item"))
    none = entries(spark, sf_dir).withColumn("ativo", F.lit(False))
    return enrich(rows, catalogue_mapping(none)).select(
        *_ID, "material_id", "material", "unidade_padrao"
    )


_DEDUP = ("id_compra", "id_item_compra", "codigo_item_catalogo", "record_hash", "arrival")


def _dedup_twin(keys: str) -> str:
    return (
        f"WITH p AS ({purchases_sql(_DEDUP)}) SELECT * FROM p QUALIFY row_number() OVER"
        f" (PARTITION BY {keys} ORDER BY arrival DESC NULLS LAST, id_compra DESC NULLS LAST,"
        " id_item_compra DESC NULLS LAST, codigo_item_catalogo DESC NULLS LAST) = 1"
    )


def _newest() -> list:
    return [
        F.col(c).desc_nulls_last()
        for c in ("arrival", "id_compra", "id_item_compra", "codigo_item_catalogo")
    ]


@query("dedup_by_hash", _dedup_twin("record_hash"))
def by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(purchases(spark, sf_dir, _DEDUP), order=_newest())


@query(
    "dedup_by_hash_keep_null",
    f"WITH d AS ({_dedup_twin('record_hash')}), p AS ({purchases_sql(_DEDUP)})"
    " SELECT * FROM d WHERE record_hash IS NOT NULL"
    " UNION ALL SELECT * FROM p WHERE record_hash IS NULL",
)
def by_hash_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(purchases(spark, sf_dir, _DEDUP), order=_newest(), null_hash="keep")


_KEYED = tuple(c for c in _DEDUP if c != "record_hash")


@query(
    "dedup_by_key",
    _dedup_twin("id_compra, id_item_compra, codigo_item_catalogo").replace(
        purchases_sql(_DEDUP), purchases_sql(_KEYED)
    ),
)
def by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(purchases(spark, sf_dir, _KEYED), order=_newest())


_WHOLE = ("codigo_item_catalogo", "unidade_original", "uf", "data_compra")


@query(
    "dedup_whole_rows",
    f"WITH p AS ({purchases_sql(_WHOLE)}) SELECT DISTINCT codigo_item_catalogo AS code,"
    " unidade_original, uf, data_compra FROM p",
)
def whole_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases(spark, sf_dir, _WHOLE).withColumnRenamed("codigo_item_catalogo", "code")
    return comparable(deduplicate(rows))


_DERIVED = (
    "ano", "mes", "ano_mes", "trimestre", "semestre", "regiao", "unidade_normalizada",
)


@query(
    "derived_columns",
    f"WITH {flagged_sql()} SELECT {', '.join((*_ID, *_DERIVED))},"
    f" {rounded('valor_total_item', 'preco_normalizado')} FROM f",
)
def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flagged_purchases(spark, sf_dir)
    return comparable(rows.select(*_ID, *_DERIVED, "valor_total_item", "preco_normalizado"))


_FLAGS = (
    "is_valid_catmat", "is_valid_date", "is_valid_price", "is_valid_quantity", "is_valid_uf",
    "is_valid_record", "quality_issues",
)


@query("quality_flags", f"WITH {flagged_sql()} SELECT {', '.join((*_ID, *_FLAGS))} FROM f")
def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged_purchases(spark, sf_dir).select(*_ID, *_FLAGS)


_OUTLIER = (*_ID, "codigo_item_catalogo", "ano_mes", "is_outlier", "outlier_reason")


@query("iqr_outliers", f"WITH {flagged_sql()}, {IQR_SQL} SELECT {', '.join(_OUTLIER)} FROM o")
def iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iqr_outliers(cleaned_purchases(spark, sf_dir)).select(*_OUTLIER)


@query(
    "iqr_outliers_large_groups",
    f"WITH {flagged_sql()}, {IQR_SQL} SELECT {', '.join(_OUTLIER)} FROM o",
)
def iqr_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken past the size bounds: limits by counting, spread join."""
    rows = cleaned_purchases(spark, sf_dir)
    return iqr_outliers(rows, group_rows=0, broadcast_rows=0).select(*_OUTLIER)


@query(
    "percentile_outliers",
    f"""WITH {flagged_sql()}, {outliers_sql('f', 0.01, 0.99,
        'preco_normalizado < q1 OR preco_normalizado > q3', 'PERCENTILE_0.01_0.99')}
    SELECT {', '.join(_OUTLIER)} FROM o""",
)
def percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return percentile_outliers(cleaned_purchases(spark, sf_dir)).select(*_OUTLIER)


@query(
    "quantiles_by_counting",
    f"""WITH p AS ({purchases_sql(('codigo_item_catalogo', 'preco_unitario'))})
    SELECT codigo_item_catalogo, count(preco_unitario) AS group_rows,
    round(quantile_cont(preco_unitario, 0.01), 4) + 0.0 AS p01,
    round(quantile_cont(preco_unitario, 0.5), 4) + 0.0 AS p50,
    round(quantile_cont(preco_unitario, 0.999), 4) + 0.0 AS p999 FROM p GROUP BY ALL""",
)
def counted_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases(spark, sf_dir, ("codigo_item_catalogo", "preco_unitario"))
    solved, _ = group_quantiles(
        rows, ["codigo_item_catalogo"], "preco_unitario", (0.01, 0.5, 0.999), group_rows=0
    )
    names = {n: F.col("quantiles")[i] for i, n in enumerate(("p01", "p50", "p999"))}
    return comparable(solved.withColumns(names).drop("quantiles"))


SILVER_SQL = f"""{CANONICAL_SQL},
    k AS (SELECT * FROM c WHERE data_compra IS NULL OR data_compra >= TIMESTAMP '{START_DATE}'),
    u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY record_hash
      ORDER BY arrival DESC NULLS LAST) = 1), {flagged_sql('u')}, {IQR_SQL}"""


def silver(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> SilverResult:
    """The whole Silver transformation of landed text records, as a written table of the
    ``columns`` a query reads."""
    bronze = stage(raw_records(spark, sf_dir), "bronze")
    mapping = catalogue_mapping(entries(spark, sf_dir))
    return transform_silver(bronze, mapping, SETTINGS, columns=columns)


_SILVER = (
    "id_compra", "id_item_compra", "record_hash", "codigo_item_catalogo", "material_id",
    "descricao_item", "unidade_normalizada", "uf", "regiao", "data_compra", "ano_mes",
    "is_valid_record", "quality_issues", "is_outlier", "outlier_reason",
)
_SILVER_NUMBERS = ("quantidade", "preco_normalizado", "valor_total_item")


@query(
    "silver_records",
    f"WITH {SILVER_SQL} SELECT {', '.join(_SILVER)}, {rounded(*_SILVER_NUMBERS)} FROM o",
)
def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = (*_SILVER, *_SILVER_NUMBERS)
    return comparable(silver(spark, sf_dir, shown).records.select(*shown))


@query(
    "silver_metrics",
    f"""WITH {SILVER_SQL} SELECT (SELECT count(*) FROM raw) AS records_input,
    count(*) AS records_output, (SELECT count(*) FROM k) - count(*) AS duplicates_removed,
    count(*) FILTER (WHERE NOT is_valid_record) AS invalid_records, count(*) FILTER (WHERE is_outlier) AS outliers FROM o""",
)
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, ()).metrics


@query(
    "silver_checks",
    f"""WITH p AS ({purchases_sql(('id_compra', 'id_item_compra', 'codigo_item_catalogo', 'descricao_item'))}),
    k AS (SELECT count(*) AS n FROM p GROUP BY id_compra, id_item_compra, codigo_item_catalogo)
    SELECT (SELECT count(*) FROM p) AS records,
    (SELECT count(*) FILTER (WHERE n > 1) FROM k) AS duplicate_technical_keys,
    (SELECT count(*) FILTER (WHERE descricao_item IS NULL) FROM p) AS null_descriptions""",
)
def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("id_compra", "id_item_compra", "codigo_item_catalogo", "descricao_item")
    return silver_checks(purchases(spark, sf_dir, columns))


@query(
    "dim_material",
    f"WITH {flagged_sql()} SELECT DISTINCT codigo_item_catalogo, material_id, material,"
    " categoria_material, unidade_padrao FROM f",
)
def materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("codigo_item_catalogo", "descricao_item", "data_compra")
    rows = within_period(purchases(spark, sf_dir, columns), START_DATE)
    return material_dimension(enrich(rows, catalogue_mapping(entries(spark, sf_dir))))


@query(
    "dim_date",
    f"""WITH p AS ({purchases_sql(('data_compra',))}), s AS (SELECT min(data_compra) AS a,
      max(data_compra) AS b FROM p), d AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS data FROM s)
    SELECT strftime(data, '%Y-%m-%d') AS data, year(data) AS ano, month(data) AS mes, day(data) AS dia,
    strftime(data, '%Y-%m') AS ano_mes, year(data) || 'Q' || quarter(data) AS trimestre,
    year(data) || CASE WHEN month(data) <= 6 THEN '-S1' ELSE '-S2' END AS semestre FROM d""",
)
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = date_dimension(purchases(spark, sf_dir, ("data_compra",)))
    return days.withColumn("data", F.col("data").cast("string"))


@query(
    "eligible_materials",
    f"""WITH {flagged_sql()} SELECT codigo_item_catalogo, count(*) AS registros,
    count(DISTINCT ano_mes) AS meses, min(ano_mes) AS primeiro_mes, max(ano_mes) AS ultimo_mes
    FROM f WHERE is_valid_record AND unidade_normalizada IS NOT NULL
    AND data_compra >= TIMESTAMP '{START_DATE}' GROUP BY ALL
    HAVING count(*) >= 10 AND count(DISTINCT ano_mes) >= 2""",
)
def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible_materials(flagged_purchases(spark, sf_dir), start_date=START_DATE)


# Factors per pair of units, from the catalogue's own units and part sizes.
_RULES = (
    "SELECT 'un' AS de, unidade_padrao AS para, CAST(max(p_size) AS DOUBLE) AS fator"
    " FROM (SELECT p_size, CASE WHEN p_size % 2 = 0 THEN 'kg' END AS unidade_padrao FROM part"
    " WHERE p_size > 25) GROUP BY unidade_padrao HAVING unidade_padrao IS NOT NULL"
)
_CONVERTED = (*_ID, "unidade_normalizada", "conversao_desconhecida")


@query(
    "unit_conversion",
    f"""WITH {flagged_sql()}, r AS ({_RULES}),
    j AS (SELECT d.*, fator, unidade_original <> unidade_padrao AS open_pair
      FROM d LEFT JOIN r ON unidade_original = de AND unidade_padrao = para)
    SELECT {', '.join(_ID)},
      CASE WHEN coalesce(open_pair, false) AND fator IS NULL THEN unidade_original
        ELSE coalesce(unidade_padrao, unidade_original) END AS unidade_normalizada,
      coalesce(open_pair, false) AND fator IS NULL AS conversao_desconhecida,
      round(CASE WHEN open_pair AND fator > 0 THEN preco_unitario / fator
        ELSE preco_unitario END, {DIGITS}) + 0.0 AS preco_normalizado FROM j""",
)
def conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (*_ID, "codigo_item_catalogo", "descricao_item", "unidade_original", "preco_unitario", "data_compra")
    rows = within_period(purchases(spark, sf_dir, columns), START_DATE)
    enriched_rows = enrich(rows, catalogue_mapping(entries(spark, sf_dir)))
    parts = table(spark, sf_dir, "part").filter("p_size > 25").withColumn(
        "para", F.expr("CASE WHEN p_size % 2 = 0 THEN 'kg' END")
    )
    rules = parts.filter("para IS NOT NULL").groupBy("para").agg(
        F.max("p_size").cast("double").alias("fator")
    )
    converted = convert_units(enriched_rows, rules.withColumn("de", F.lit("un")))
    return comparable(converted.select(*_CONVERTED, "preco_normalizado"))
