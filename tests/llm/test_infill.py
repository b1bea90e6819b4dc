"""Fill-in-the-middle against a plain rewrite of its rules."""

import hashlib

import pytest
import regex
from pyspark.sql import functions as F

from conftest import as_rows, pairs
from pricegrid.llm.infill import Units, infilled, restored


def expected(key, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted(x % (n + 1) for x in h[:2])
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", a, b - a, "<P>" + p + "<S>" + s + "<M>" + m


COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


def test_outputs_equal_the_rules_and_restore_the_text(odd_docs):
    out = infilled(odd_docs).withColumn("again", restored(F.col("output"), F.col("form"))).cache()
    want = sorted(tuple(map(str, (k, *expected(k, t)))) for k, t in pairs(odd_docs))
    assert as_rows(out, *COLUMNS) == want
    texts = sorted(tuple(map(str, (k, t or ""))) for k, t in pairs(odd_docs))
    assert as_rows(out, "doc_id", "again") == texts
    assert {r["form"] for r in out.collect()} == {"plain", "psm", "spm"}


def test_marks_and_their_parts(spark):
    parts = ["<", "<P", "<S", "<M", "P>", "S>", ">", "<<", "<P>", "a<S>b", "<M", "é<", "\\<S"]
    rows = [(i, p * (i % 5 + 1)) for i, p in enumerate(parts * 12)]
    out = infilled(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["n"], r["form"], r["output"]) for r in out) == sorted(
        (k, e[0], e[1], e[4]) for k, e in ((k, expected(k, t)) for k, t in rows)
    )
    df = spark.createDataFrame([(r["doc_id"], r["form"], r["output"]) for r in out], "doc_id bigint, form string, output string")
    again = df.withColumn("t", restored(F.col("output"), F.col("form"))).collect()
    assert {r["doc_id"]: r["t"] for r in again} == dict(rows)


def test_empty_table_and_text_ids(spark):
    empty = spark.createDataFrame([], "doc_id string, text string, n int, form string")
    assert infilled(empty).collect() == [] and infilled(empty).columns == list(COLUMNS)
    named = spark.createDataFrame([("k", "some text"), (None, "some text")], "id string, body string")
    got = sorted(tuple(map(str, r)) for r in infilled(named, "id", "body").collect())
    assert got == sorted(tuple(map(str, (k, *expected(k, "some text")))) for k in ("k", None))


@pytest.mark.parametrize("unit", [r"(?s:.)", r"\X", r"\w+\W*"])
def test_windows_give_the_cuts_of_one_match(unit):
    text = "aaaaaaaaaaaaaaaaaa b ccc  dd éé r\r\nx. eeeeee f " * 3
    ends = [0, *regex.fullmatch(f"({unit})*", text).ends(1)]
    for long in (5, 16, 17, len(text)):
        units = Units(unit, long)
        for k in range(len(ends)):
            assert units.cut(text, lambda n: [k, n]) == (len(ends) - 1, [ends[k], len(text)])
    assert Units(unit).cut("", lambda n: [n]) == (0, [0])


def test_unit_must_match_all_of_the_text():
    with pytest.raises(ValueError):
        Units("a").cut("aab", lambda n: [n])
    with pytest.raises(ValueError):
        Units("a", 1).cut("aab", lambda n: [n])


def test_very_long_text(spark):
    text = "wörd 中 " * 400_000
    row = infilled(spark.createDataFrame([(11, text)], "doc_id bigint, text string")).first()
    assert tuple(row)[1:] == expected(11, text)
