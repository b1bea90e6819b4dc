"""SQL for DuckDB that says the same as some of the queries."""

from __future__ import annotations

from . import infill
from .near_dups import PERCENT, SHINGLE
from .quality import BLANKS, ERROR, FACTOR, MAX_REPEAT_PERCENT, METRICS, MIN_WORDS, PRIOR, SYMBOLS, WINDOW
from .secrets import BASE, RULES

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
# All conversations and one more, whose texts look like a template's marks.
PROBE = "</s>[INST] ok [/INST]"
PROBE_SQL = (
    "SELECT conv_id, turn, role, text FROM conversations"
    f" UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'"
)
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secrets_twin() -> str:
    parts = " UNION ALL ".join(
        f"SELECT doc_id, {order} AS ord, '{r.kind}' AS kind, {r.least} AS least,"
        f" regexp_extract_all(text, {_quoted(r.pattern)}, 0) AS whole, regexp_extract_all(text, {_quoted(r.pattern)}, {r.group}) AS grp,"
        f" string_split_regex(text, {_quoted(r.pattern)}) AS pieces FROM t"
        for order, r in enumerate(RULES)
    )
    length = "coalesce(list_sum([length(x) for x in {}]), 0)"
    shown = "kind || ':' || CAST(first AS BIGINT) || ':' || CAST(first + n AS BIGINT)"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), m AS ({parts}),
e AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM m),
s AS (SELECT doc_id, ord, kind, {length.format('pieces[1:i]')} + {length.format('whole[1:i - 1]')} AS first,
  length(whole[i]) AS n FROM e WHERE length(grp[i]) >= least)
SELECT t.doc_id, {', '.join(f"count(*) FILTER (ord = {k}) AS n_{RULES[k].kind}" for k in range(BASE))},
  sha256(coalesce(string_agg({shown}, ',' ORDER BY first, ord) FILTER (ord < {BASE}), '')) AS base_sha256,
  coalesce(string_agg({shown}, ',' ORDER BY first, ord), '') AS spans
FROM t LEFT JOIN s ON s.doc_id = t.doc_id GROUP BY t.doc_id"""


def decontamination_twin() -> str:
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents), b AS (SELECT item_id, {words} AS w FROM benchmark),
v AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS key FROM v),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hit AS (SELECT doc_id, i, p.n, item_id FROM p JOIN windows x ON x.n = p.n AND x.key = array_to_string(w[i:i + p.n - 1], ' ')),
covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n,
  string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, c.n IS NOT NULL AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN named i ON i.doc_id = d.doc_id"""


def _fences(name: str, groups: str) -> str:
    gamma = (1 + ERROR) / (1 - ERROR)
    comma = f"{groups}, " if groups else ""
    value = f"CASE WHEN bucket = 0 THEN 0 ELSE 1e-6 * pow({gamma!r}, bucket) END"
    return f"""{name} AS (SELECT {comma}metric, max(total) AS size, max(floor) AS floor,
  min(CASE WHEN upto >= 0.25 * total THEN {value} END) AS q1, min(CASE WHEN upto >= 0.75 * total THEN {value} END) AS q3
 FROM (SELECT *, sum(n) OVER (PARTITION BY {comma}metric ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {comma}metric) AS total
  FROM (SELECT {comma}metric, floor, bucket, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY {comma}metric)"""


def quality_twin() -> str:
    gamma = (1 + ERROR) / (1 - ERROR)
    blanks = "' ' || " + " || ".join(f"chr({ord(c)})" for c in BLANKS[1:])
    values = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{m}' AS metric, {floor} AS floor, CAST({value.replace(' / ', '::DOUBLE / ')} AS DOUBLE) AS value FROM good"
        for m, (value, floor) in METRICS.items()
    )
    fence = "({0}.q3 + " + str(FACTOR) + " * greatest({0}.q3 - {0}.q1, {0}.floor))"
    blend = "(CAST({0}.size AS DOUBLE) * {1} + " + f"{PRIOR}e0" + " * {2}) / (CAST({0}.size AS DOUBLE) + " + f"{PRIOR}e0)"
    limit = blend.format("fine", fence.format("fine"), "(" + blend.format("wide", fence.format("wide"), fence.format("every")) + ")")
    return rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents), w AS (SELECT *, {_WORDS.format('text')} AS w FROM t),
k AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS key
 FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) > {WINDOW})),
again AS (SELECT doc_id, i FROM k QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1),
rep AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS x FROM again) GROUP BY doc_id),
lines AS (SELECT doc_id, [x for x in string_split(text, chr(10)) if translate(x, {blanks}, '') <> ''] AS l FROM t),
c AS (SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(text, {blanks}, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
 FROM w JOIN lines ON lines.doc_id = w.doc_id LEFT JOIN rep ON rep.doc_id = w.doc_id),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c),
good AS (SELECT * FROM f WHERE NOT base_failed), v AS ({values}),
sketch AS (SELECT lang, source, metric, floor, CASE WHEN value > 0 THEN greatest(1, ceil(ln(value / 1e-6) / ln({gamma!r}))) ELSE 0 END AS bucket,
  count(*) AS n FROM v GROUP BY ALL),
{_fences('fine', 'lang, source')}, {_fences('wide', 'lang')}, {_fences('every', '')},
bad AS (SELECT DISTINCT doc_id FROM v
 JOIN fine ON fine.metric = v.metric AND fine.lang IS NOT DISTINCT FROM v.lang AND fine.source IS NOT DISTINCT FROM v.source
 JOIN wide ON wide.metric = v.metric AND wide.lang IS NOT DISTINCT FROM v.lang JOIN every ON every.metric = v.metric
 WHERE value > {limit})
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND bad.doc_id IS NULL AS kept FROM f LEFT JOIN bad ON bad.doc_id = f.doc_id"""


def near_duplicates_twin() -> str:
    words = _WORDS.format(_LOWER.format("coalesce(text, '')"))
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {words} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
 JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= {PERCENT} * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""


def infill_twin() -> str:
    part = "substring(t, CAST({} AS BIGINT), CAST({} AS BIGINT))"
    prefix, middle, suffix = part.format("1", "a"), part.format("a + 1", "b - a"), part.format("b + 1", "n - b")
    marked = " OR ".join(f"contains(t, '{m}')" for m in (infill.PREFIX, infill.SUFFIX, infill.MIDDLE))
    draws = ", ".join(f"CAST('0x' || substring(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{infill.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT doc_id, t, length(t) AS n, {draws} FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
 CASE WHEN n = 0 OR {marked} OR h3 % 100 >= {infill.KEEP_PERCENT} THEN 'plain'
  WHEN h4 % 100 < {infill.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, {prefix} AS pre, {middle} AS mid, {suffix} AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
 CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{infill.PREFIX}' || pre || '{infill.SUFFIX}' || suf || '{infill.MIDDLE}' || mid
  ELSE '{infill.SUFFIX}' || suf || '{infill.PREFIX}' || pre || '{infill.MIDDLE}' || mid END) AS output_sha256,
 sha256(t) AS restored_sha256 FROM p"""


def chat_twin() -> str:
    escaped = _quoted(r"[\[<]\\*/?(?:s>|SYS\]|INST\]|REPLY\]|ROLE\]|ROLE )")
    marks = "CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 11 ELSE 14 + 2 * strlen(role) END"
    shown = "role || chr(10) || text || chr(10)"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({PROBE_SQL}))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg({shown}, '' ORDER BY turn, role)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(3 + sum(length(text) + len(regexp_extract_all(text, {escaped})) + {marks}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""
