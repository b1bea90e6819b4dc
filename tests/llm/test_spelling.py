"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from conftest import pairs
from pricegrid.llm.spelling import letter_counts, near_words, one_edit, variants, word_counts

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def counted(docs, typo_every, least=6, min_count=5):
    out = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if typo_every and h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= least and n >= min_count}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(words, ratio=5):
    around = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if near(a, b):
            around[a].append(b)
            around[b].append(a)
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    rows = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, words[w], len(around[w]), words[form[w]] if form[w] else None))
    return sorted(rows, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def vocabulary():
    r = random.Random(11)
    words = {"".join(r.choice("abéo") for _ in range(r.randrange(5, 10))) for _ in range(500)}
    words |= {"".join(r.choice("xyzÿ×") for _ in range(6)) for _ in range(150)}
    words |= {w[:-1] + "q" for w in list(words)[:60]} | {"a" * n for n in (5, 6, 7, 2500, 2501, 2502)} | {"ab", "a", "中文字", "中文"}
    return {w: 5 ** r.randrange(0, 6) + r.randrange(3) for w in sorted(words)}


@pytest.mark.parametrize("block", [3, 2048])
def test_variants_equal_brute_force(spark, vocabulary, block):
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint").repartition(3)
    assert found(variants(df, block=block)) == grouped(vocabulary)


def test_each_pair_once(spark, vocabulary):
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    got = [(r["word"], r["near"]) for r in near_words(df, 7).collect()]
    want = {frozenset(p) for p in combinations(vocabulary, 2) if near(*p)}
    assert len(got) == len(want) and {frozenset(p) for p in got} == want


@pytest.mark.parametrize("typo_every", [0, 3, 199])
def test_counts_equal_brute_force(odd_docs, typo_every):
    got = {r["word"]: r["n"] for r in word_counts(odd_docs, typo_every=typo_every).collect()}
    assert got == counted(pairs(odd_docs), typo_every) and got


def test_chains_and_ties(spark):
    # aaaaab -> aaaaaa by n; a chain of forms; two forms of equal n, the first one wins
    words = {"aaaaaa": 3125, "aaaaab": 625, "aaaabb": 125, "aaabbb": 25, "aabbbb": 5, "zzzzza": 50, "zzzzzb": 50, "zzzzzc": 10}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    rows = {r["word"]: r for r in variants(df).collect()}
    assert rows["aabbbb"]["form"] == "aaabbb" and rows["aabbbb"]["root"] == "aaaaaa"
    assert rows["zzzzzc"]["form"] == "zzzzza" and rows["zzzzza"]["form"] is None and rows["zzzzza"]["n_near"] == 2
    assert found(variants(df)) == grouped(words)


def test_empty_tables_and_null_words(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert variants(word_counts(empty)).collect() == []
    df = spark.createDataFrame([(None, 9), ("alone", 1)], "word string, n bigint")
    assert found(variants(df)) == [("alone", None, "alone", 1, 0, None), (None, None, None, 9, 0, None)]


def test_edits_and_distances():
    words = np.array(["abcdef", "abcdeg", "abdcef", "abcdefg", "xabcdef", "bcdef", "abcdef", "abcxdeg"], object)
    i, j = map(np.array, zip(*combinations(range(len(words)), 2), strict=True))
    assert one_edit(words, i, j).tolist() == [near(words[a], words[b]) for a, b in zip(i, j, strict=True)]
    counts = letter_counts(words)
    assert ((counts[0] - counts[1]) ** 2).sum() == 2 and ((counts[0] - counts[3]) ** 2).sum() == 1


def test_very_long_text(spark):
    text = "lighthouse " * 300_000 + "lighthuose lighthous " * 20
    rows = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = {r["word"]: (r["n"], r["form"]) for r in variants(word_counts(rows)).collect()}
    assert got == {"lighthouse": (300_000, None), "lighthous": (20, "lighthouse"), "lighthuose": (20, None)}
