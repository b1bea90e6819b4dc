"""Secret scans behind a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query. The index holds the
postings (trigram, row) of the trigrams that occur in some query; postings of a
query are intersected by counting, and only candidate rows are verified with the
rule's expression. Rules without mandatory trigrams scan every text. All of it is
DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import written
from .trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """Matches are leftmost and do not overlap; those whose group is shorter than
    ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base kinds in their order, then kinds added by this operator.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
BASE = 3


def rule_queries(rules: tuple[Rule, ...] = RULES) -> list[list[list[list[str]]]]:
    return [trigram_query(r.pattern) for r in rules]


def postings(keyed: DataFrame, grams: list[str]) -> DataFrame:
    """The inverted index: a row (gram, row_key) for each of the given trigrams that
    a text holds in any case."""
    low = F.lower(F.col("text"))
    held = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(g)), F.lit(g)) for g in grams]))
    return keyed.select("row_key", F.explode(held).alias("gram")).sortWithinPartitions("gram")


def candidates(index: DataFrame, queries: list[list[list[list[str]]]]) -> DataFrame:
    """Per row the rules whose query its postings satisfy (``rules``, sorted)."""
    rows = [
        (r, c, t, gram, len(term), len(query))
        for r, query in enumerate(queries)
        for c, clause in enumerate(query)
        for t, term in enumerate(clause)
        for gram in term
    ]
    terms = index.sparkSession.createDataFrame(
        rows, "rule int, clause int, term int, gram string, grams int, clauses int"
    )
    met = (
        index.join(F.broadcast(terms), "gram")  # the rules' own trigrams: fixed and few
        .groupBy("row_key", "rule", "clause", "term")
        .agg(F.count_distinct("gram").alias("n"), F.first("grams").alias("grams"), F.first("clauses").alias("clauses"))
        .where(F.col("n") == F.col("grams"))
    )
    return (
        met.groupBy("row_key", "rule")
        .agg(F.count_distinct("clause").alias("n"), F.first("clauses").alias("clauses"))
        .where(F.col("n") == F.col("clauses"))
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_set("rule")).alias("rules"))
    )


_SPAN = "array<struct<start:int,ord:int,end:int>>"


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of a rule's matches as code points: the pieces between matches and the
    matches, taken in turn, give the places."""
    pieces = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    turns = F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), group.alias("group"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"))
        more = F.coalesce(F.length(x["group"]) >= rule.least, F.lit(False))
        return F.struct(
            end.alias("at"), F.when(more, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out")
        )

    first = F.struct(F.lit(0).alias("at"), F.expr(f"array() :: {_SPAN}").alias("out"))
    return F.aggregate(turns, first, step)["out"]


def secret_spans(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    carried: Column | None = None,
) -> DataFrame:
    """Per document ``found``: all spans (start, ord, end) by start and rule, with the
    text they were found in, and a further column if one is given to be ``carried``.

    A null text is an empty one and has no spans. Rows are matched with the index by
    a hash of id and text, so null or repeated ids and repeated rows keep their own
    rows; a chance match of hashes only verifies a text for nothing. Other columns
    are ignored.
    """
    more = [] if carried is None else [carried.alias("carried")]
    keyed = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        *more,
    ).withColumn("row_key", F.xxhash64("doc_id", "text"))
    queries = rule_queries(rules)
    grams = sorted({g for q in queries for c in q for t in c for g in t})
    index = written(postings(keyed, grams), "trigrams")
    marked = keyed.join(candidates(index, queries), "row_key", "left")
    text_col, empty = F.col("text"), F.expr(f"array() :: {_SPAN}")
    parts = []
    for order, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        candidate = F.coalesce(F.array_contains("rules", order), F.lit(False)) if query else F.lit(True)
        hit = candidate & F.rlike(text_col, F.lit(rule.pattern))
        parts.append(F.when(hit, _spans(text_col, rule, order)).otherwise(empty))
    kept = ["doc_id", "text"] + (["carried"] if more else [])
    return marked.select(*kept, F.sort_array(F.concat(*parts)).alias("found"))


def redacted(
    docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The documents, all columns in place, with each secret in the text replaced by
    its kind in brackets (overlapping spans by the first one's), and the number of
    characters adjusted where there is such a column. Null texts stay null."""
    others = [c for c in docs.columns if c not in (text, chars)]
    rest = F.struct(F.col(f"`{text}`").isNull().alias("_null"), *[F.col(f"`{c}`") for c in others])
    names = F.array(*[F.lit(r.kind) for r in rules])
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.col("text").alias("text"))

    def step(acc: Column, span: Column) -> Column:
        apart = span["start"] >= acc["at"]
        before = F.substring(acc["text"], acc["at"] + 1, span["start"] - acc["at"])
        mark = F.concat(F.lit("["), F.get(names, span["ord"]), F.lit("]"))
        return F.struct(
            F.greatest(acc["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(acc["out"], before, mark)).otherwise(acc["out"]).alias("out"),
            acc["text"].alias("text"),
        )

    ended = F.aggregate(
        "found", first, step, lambda acc: F.concat(acc["out"], F.substring(acc["text"], acc["at"] + 1, 2**31 - 1))
    )
    spans = secret_spans(docs, key, text, rules, rest)
    new = F.when(~F.col("carried._null"), F.when(F.size("found") == 0, F.col("text")).otherwise(ended))
    done = spans.select("carried", new.alias("new"))
    kinds = dict(docs.dtypes)
    columns = {text: F.col("new"), chars: F.length("new").cast(kinds.get(chars, "bigint"))}
    return done.select(*[columns.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def joined_spans(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(":", F.get(names, s["ord"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def secret_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of spans of each base kind, the digest of the base
    spans and all spans as text."""
    spans = secret_spans(docs, key, text)
    count = lambda k: F.size(F.filter("found", lambda s: s["ord"] == k)).cast("bigint")
    base = F.filter("found", lambda s: s["ord"] < BASE)
    return spans.select(
        "doc_id",
        *[count(k).alias(f"n_{RULES[k].kind}") for k in range(BASE)],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("found")).alias("spans"),
    )
