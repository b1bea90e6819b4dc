"""The operators over the given tables, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe,
    chat,
    decontaminate,
    infill,
    lm,
    near_dups,
    packing,
    quality,
    secrets,
    spelling,
    substrings,
    tokenfile,
    twins,
    url_lists,
)
from .common import query, read


@query("op1_wavelet_tokens")
def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = tokenfile.write_tokens(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return tokenfile.read_tokens(shards)


@query("op7_decontamination", twins.decontamination_twin())
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_spans(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


@query("op10_bpe_round_trip")
def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_adaptive_quality", twins.quality_twin())
def op5_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", *quality.COUNTS, "base_failed", "kept"
    )


@query("op9_secret_index", twins.secrets_twin())
def op9_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_counts(read(spark, sf_dir, "documents"))


@query("op4_min_max_near_duplicates", twins.near_duplicates_twin())
def op4_min_max_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(read(spark, sf_dir, "documents"))


@query("op3_best_fit_shards")
def op3_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sharded(read(spark, sf_dir, "documents"))


# The pages carry neither times nor lists, so both are derived from them in SQL that
# both engines share: a day of fetching for each page, and for each host, its domain and
# some URLs a history of dated entries.
_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1))"
_DAY = "CAST('2024-01-01' AS DATE) + CAST({} AS INT)"
_CAPTURES = f"SELECT page_id, url, {_DAY.format('(page_id * 7919) % 366')} AS fetched_on FROM pages"
_SOURCES = f"""
 SELECT 'host' AS kind, {_HOST} AS pattern, min(page_id) AS m FROM pages GROUP BY {_HOST}
 UNION ALL
 SELECT 'host', regexp_extract({_HOST}, '([^.]+[.][^.]+)$', 1), min(page_id) + 3 FROM pages
 GROUP BY regexp_extract({_HOST}, '([^.]+[.][^.]+)$', 1)
 UNION ALL
 SELECT 'url', url, min(page_id) FROM pages GROUP BY url HAVING min(page_id) % 10 = 0"""
_STEPS = (
    # list, allows, adds, day, condition
    ("adult", "FALSE", "TRUE", "(m * 31) % 200", "m % 2 = 0"),
    ("adult", "FALSE", "FALSE", "(m * 31) % 200 + 60", "m % 4 = 0"),
    ("adult", "FALSE", "TRUE", "(m * 31) % 200 + 90", "m % 8 = 0"),
    ("malware", "FALSE", "TRUE", "(m * 17) % 300", "m % 3 = 0"),
    ("malware", "FALSE", "FALSE", "(m * 17) % 300", "m % 9 = 0"),
    ("trusted", "TRUE", "TRUE", "(m * 13) % 250", "m % 5 = 0"),
    ("trusted", "TRUE", "FALSE", "(m * 13) % 250 + 45", "m % 5 = 0"),
)
_ENTRIES = f"WITH sources AS ({_SOURCES})" + " UNION ALL".join(
    f" SELECT '{name}' AS list, {allow} AS allow, kind, pattern, {adds} AS added, {_DAY.format(day)} AS on_day"
    f" FROM sources WHERE pattern <> '' AND {condition}"
    for name, allow, adds, day, condition in _STEPS
)


@query(
    "op2_temporal_lists",
    f"""
WITH captures AS ({_CAPTURES}), entries AS ({_ENTRIES}),
spans AS (SELECT *, coalesce(lead(on_day) OVER (PARTITION BY list, kind, pattern ORDER BY on_day, added, allow),
 CAST('2100-01-01' AS DATE)) AS until FROM (SELECT DISTINCT * FROM entries)),
active AS (SELECT c.page_id, c.url, c.fetched_on, s.list, s.allow
 FROM (SELECT DISTINCT *, {_HOST} AS host FROM captures) c JOIN spans s ON s.added AND s.on_day <= c.fetched_on AND c.fetched_on < s.until
 AND (s.kind = 'url' AND s.pattern = c.url OR s.kind = 'host' AND (s.pattern = c.host OR ends_with(c.host, '.' || s.pattern)))),
found AS (SELECT page_id, url, fetched_on, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
 bool_or(allow) AS allowed, bool_or(NOT allow) AS denied FROM active GROUP BY ALL)
SELECT c.page_id, {_HOST.replace('url', 'c.url')} AS host, c.fetched_on, coalesce(f.n, 0) AS n_active, coalesce(f.lists, '') AS lists,
 coalesce(f.denied AND NOT f.allowed, FALSE) AS blocked
FROM captures c LEFT JOIN found f ON f.page_id = c.page_id AND f.url = c.url AND f.fetched_on = c.fetched_on""",
)
def op2_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "pages").createOrReplaceTempView("pages")
    entries = spark.sql(_ENTRIES).withColumnRenamed("on_day", "on")
    return url_lists.listed(spark.sql(_CAPTURES), entries)


@query("op6_merged_suffixes")
def op6_merged_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_spans(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query("op8_log_bilinear_scores")
def op8_log_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(read(spark, sf_dir, "documents"))


@query("op12_fill_in_middle", twins.infill_twin())
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.infilled(read(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = spelling.word_counts(read(spark, sf_dir, "documents"), typo_every=spelling.TYPO_EVERY)
    return spelling.variants(counted)


@query("op13_reply_trees", twins.chat_twin())
def op13_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "conversations").createOrReplaceTempView("conversations")
    shown = chat.conversations(spark.sql(twins.PROBE_SQL))
    back = shown.select(
        "conv_id",
        chat.turns_of(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )
