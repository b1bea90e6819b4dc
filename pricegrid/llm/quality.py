"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Everything is DataFrame expressions. The counts of a text are array expressions
over its own row, so texts are never exploded or shuffled. The sketch of a metric
is a table of counts by logarithmic bucket: sketches of parts merge by adding
counts, quantiles have a relative error of at most ``ERROR``, and the result does
not depend on how rows were dealt out. A group (language, source) has at most a few
hundred buckets for each metric, so its thresholds come from a small table that is
joined back.

A threshold is an upper fence: third quartile plus FACTOR times the spread between
the quartiles, the spread being at least a floor given for each metric. One rule holds
for groups of any size: the fence of a language counts like PRIOR documents of each of
its groups, and the fence of all documents like PRIOR documents of each language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ERROR = 0.01  # relative error of a sketched quantile
FACTOR = 4.0
PRIOR = 100.0

COUNTS = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Metric: its value from the counts, and the least spread of a fence.
METRICS = {
    "word_length": ("word_chars / n_words", 0.5),
    "symbol_ratio": ("n_symbols / word_chars", 0.02),
    "dup_line_ratio": ("n_dup_lines / n_words", 0.05),
}


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.expr("array() :: array<string>")).otherwise(
        F.split(trimmed, r"[ \t\n\x0B\f\r]+")
    )


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _window_hashes(words: Column, size: int) -> Column:
    starts = F.sequence(F.lit(0), F.size(words) - size)
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


def _covered(hashes: Column, size: int) -> Column:
    """Words in windows whose hash occurs twice or more."""

    def places(ranked: Column) -> Column:
        one = lambda i: F.get(ranked, i)["h"]
        kept = F.filter(
            F.sequence(F.lit(0), F.size(ranked) - 1),
            lambda i: F.coalesce(one(i) == one(i - 1), F.lit(False)) | F.coalesce(one(i) == one(i + 1), F.lit(False)),
        )
        return F.sort_array(F.transform(kept, lambda i: F.get(ranked, i)["at"]))

    def total(at: Column) -> Column:
        step = F.aggregate(
            at,
            F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")),
            lambda acc, x: F.struct((acc["n"] + F.least(F.lit(size), x - acc["last"])).alias("n"), x.alias("last")),
        )
        return step["n"]

    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        total(_bound(ranked, places))
    )


def _repeated(words: Column, size: int) -> Column:
    return F.when(F.size(words) <= size, F.lit(0)).otherwise(
        _bound(_window_hashes(words, size), lambda h: _covered(h, size))
    )


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base counts of each text: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words. A null text counts as an empty one."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"), _repeated(words, WINDOW).cast("bigint").alias("n_repeat_words")
        )

    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    return (
        docs.withColumn("_counted", _bound(_words(body), counts))
        .withColumn("_dup_lines", _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))))
        .withColumns(
            {
                "n_words": F.col("_counted.n_words"),
                "word_chars": F.length(F.translate(body, BLANKS, "")).cast("bigint"),
                "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint"),
                "n_dup_lines": F.col("_dup_lines").cast("bigint"),
                "n_repeat_words": F.col("_counted.n_repeat_words"),
            }
        )
        .drop("_counted", "_dup_lines")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _metric(name: str) -> Column:
    return F.expr(f"CASE WHEN n_words > 0 THEN {METRICS[name][0]} END")


def sketch(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Counts by group, metric and bucket; bucket 0 holds zero, bucket b > 0 the
    values from gamma^(b-1) (exclusive) to gamma^b times the smallest value."""
    gamma = (1 + ERROR) / (1 - ERROR)
    rows = measured.select(
        *groups,
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), _metric(m).alias("value")) for m in METRICS])
        ).alias("m"),
    )
    value = F.col("m.value")
    bucket = F.when(value > 0, F.greatest(F.lit(1), F.ceil(F.log(value / 1e-6) / F.log(F.lit(gamma))))).otherwise(0)
    return (
        rows.where(value.isNotNull())
        .groupBy(*groups, F.col("m.metric").alias("metric"), bucket.cast("int").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def fences(sketched: DataFrame, groups: list[str]) -> DataFrame:
    """One row a group: its size and the fence of each metric."""
    gamma = (1 + ERROR) / (1 - ERROR)
    merged = sketched.groupBy(*groups, "metric", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*groups, "metric")
    ranked = merged.withColumns(
        {"upto": F.sum("n").over(whole.orderBy("bucket")), "total": F.sum("n").over(whole)}
    )
    value = F.when(F.col("bucket") == 0, F.lit(0.0)).otherwise(1e-6 * F.pow(F.lit(gamma), F.col("bucket")))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), value))
    quartiles = ranked.groupBy(*groups, "metric").agg(
        at(0.25).alias("q1"), at(0.75).alias("q3"), F.max("total").alias("size")
    )
    return quartiles.groupBy(*groups).agg(
        F.max("size").alias("size"),
        *[
            F.max(
                F.when(
                    F.col("metric") == m,
                    F.col("q3") + FACTOR * F.greatest(F.col("q3") - F.col("q1"), F.lit(floor)),
                )
            ).alias(m)
            for m, (_, floor) in METRICS.items()
        ],
    )


def _blended(own: Column, size: Column, wider: Column, prior: float) -> Column:
    """A group's fence and a wider one, weighted by the group's size and the prior."""
    return (size * own + F.lit(prior) * wider) / (size + F.lit(prior))


def thresholds(measured: DataFrame, lang: str, source: str, prior: float = PRIOR) -> DataFrame:
    """Fences for each language and source, drawn towards those of the language and of
    all documents, the more so the smaller a group is. Null languages and sources are
    groups of their own."""
    fine = sketch(measured, [lang, source])
    by_source, by_lang, by_all = fences(fine, [lang, source]), fences(fine, [lang]), fences(fine, [])
    wide = by_lang.crossJoin(F.broadcast(by_all.select(*[F.col(m).alias(f"all_{m}") for m in METRICS])))  # one row
    size = F.col("size").cast("double")
    wide = wide.select(
        F.col(lang).alias("_lang"),
        *[_blended(F.col(m), size, F.col(f"all_{m}"), prior).alias(f"wide_{m}") for m in METRICS],
    )
    return by_source.join(wide, by_source[lang].eqNullSafe(wide["_lang"]), "left").select(
        lang,
        source,
        *[_blended(F.col(m), size, F.col(f"wide_{m}"), prior).alias(f"max_{m}") for m in METRICS],
    )


def _judged(chosen: DataFrame, prior: float) -> DataFrame:
    """Rows (text, lang, source and anything else) without the text, with the counts,
    ``base_failed``, the metrics, their fences and ``kept``."""
    measured = written(text_counts(chosen).drop("text").withColumn("base_failed", base_failed()), "quality")
    # Written, so that Spark knows the table's size before it chooses the join.
    limits = written(thresholds(measured.where(~F.col("base_failed")), "lang", "source", prior), "fences")
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measured.join(
        limits, measured["lang"].eqNullSafe(limits["_lang"]) & measured["source"].eqNullSafe(limits["_source"]), "left"
    )
    above = F.lit(False)
    for m in METRICS:
        above = above | F.coalesce(_metric(m) > F.col(f"max_{m}"), F.lit(False))
    return joined.withColumns({"kept": ~F.col("base_failed") & ~above, **{m: _metric(m) for m in METRICS}})


def judged(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    prior: float = PRIOR,
) -> DataFrame:
    """Per document its counts, ``base_failed`` and ``kept``.

    A null or empty text has no words, so it fails the base rule. A null language
    or source is a group like any other. Repeated rows each get a row. Without
    documents there are no rows. Other columns are ignored.
    """
    names = {key: "doc_id", text: "text", lang: "lang", source: "source"}
    chosen = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return _judged(chosen, prior).select(
        "doc_id",
        "n_words",
        *COUNTS,
        "base_failed",
        "kept",
        *METRICS,
        *[f"max_{m}" for m in METRICS],
    )


def kept_documents(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", prior: float = PRIOR
) -> DataFrame:
    """The documents that ``judged`` keeps, with all their columns: nulls, repeated rows
    and empty tables as there."""
    names = {text: "text", lang: "lang", source: "source"}
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    chosen = docs.select(whole, *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return _judged(chosen, prior).where("kept").select("row.*")
