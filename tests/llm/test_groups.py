"""Near duplicates, repeated substrings and shards against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from conftest import as_rows, pairs
from pricegrid.llm import near_dups
from pricegrid.llm.components import components
from pricegrid.llm.key_filter import bitmap, passing
from pricegrid.llm.near_dups import near_duplicates
from pricegrid.llm.packing import best_fit, packed, sharded
from pricegrid.llm.substrings import repeated_spans
from pricegrid.llm.suffix_merge import front_coded, merged, shared_prefix
from test_scans import WORD


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def linked_components(docs):
    """Smallest id of each row's component; all ids given and distinct."""
    sets = {k: shingles(t) for k, t in docs}
    label = {k: k for k in sets}
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                old, new = sorted((label[a], label[b]), reverse=True)
                label = {k: new if v == old else v for k, v in label.items()}
    return sets, label


@pytest.fixture(scope="module")
def copies(spark):
    """Groups of near copies of several sizes, chains and a common passage."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage, rows = " ".join(word() for _ in range(60)), []
    for size in (1, 2, 3, 60):
        base = [word() for _ in range(r.randrange(40, 120))]
        for _ in range(size):
            text = list(base)
            for _ in range(r.randrange(0, 3)):
                text[r.randrange(len(text))] = word()
            rows.append(" ".join(text))
            if r.random() < 0.4:
                base = text
    rows += [passage + " " + " ".join(word() for _ in range(r.randrange(10, 80))) for _ in range(50)]
    rows += ["a b c", "A B c", "a b c d", "", " ", "x"] + [rows[5]] * 20
    r.shuffle(rows)
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id bigint, text string").repartition(4)


@pytest.mark.parametrize(("small", "block"), [(32, 256), (3, 8), (2, 2)])
def test_near_duplicates(copies, monkeypatch, small, block):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    sets, label = linked_components(pairs(copies))
    expected = sorted((str(k), str(len(s)), str(label[k]), str(label[k] == k)) for k, s in sets.items())
    got = as_rows(near_duplicates(copies, small=small), "doc_id", "n_shingles", "component_id", "kept")
    assert got == expected


def test_near_duplicates_of_odd_rows(odd_docs):
    got = near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r["component_id"] == r["doc_id"] for r in got if r["n_shingles"] == 0)
    same = {r["doc_id"]: r["component_id"] for r in got}
    assert same[5] == same[4] == 4
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [4]  # the base text in upper case
    kept = near_dups.distinct_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {r["doc_id"] for r in got if r["kept"]}
    assert near_duplicates(odd_docs.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(30)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    rows = got.collect()
    assert {x["node"]: x["component"] for x in rows} == {n: c for n, c in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert len(rows) == len({x["node"] for x in rows})
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_key_filter(spark):
    df = spark.range(1000).selectExpr("xxhash64(id) AS h", "id")
    words = bitmap(df.where("id < 100"), "h", bits=1 << 14)
    kept = {r["id"] for r in passing(df, "h", words).collect()}
    assert set(range(100)) <= kept and len(kept) < 200


@pytest.mark.parametrize("k", [0, 1, 2, 5, 9])
def test_loser_tree(k):
    r = random.Random(k)
    runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randrange(12))) for _ in range(r.randrange(0, 20))) for _ in range(k)]
    got = list(merged([front_coded(x) for x in runs]))
    assert [g[2] for g in got] == sorted(s for x in runs for s in x)
    assert all(runs[g[0]][g[1]] == g[2] for g in got)
    for before, after in zip(got, got[1:], strict=False):
        n = next((i for i, (x, y) in enumerate(zip(before[2], after[2], strict=False)) if x != y), min(len(before[2]), len(after[2])))
        assert after[3] == n == shared_prefix(before[2], after[2])


def removed_by_brute_force(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(t) else 0
        out.append((int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("hot", "owner"), [(500, 10_000), (2, 7), (0, 5), (6, 3)])
def test_repeated_substrings(spark, hot, owner):
    r = random.Random(8)
    made = lambda n: "".join(r.choice("abé ") for _ in range(n))
    passages = [made(n) for n in (30, 38, 45, 90, 200)]
    texts = []
    for _ in range(60):
        texts.append("".join(r.choice([made(r.randrange(60)), r.choice(passages)]) for _ in range(r.randrange(1, 5))))
    texts += [None, "", "x" * 39, "x" * 300, "ab" * 100, texts[3], texts[3], passages[1], "y" * 40, "z" * 41]
    rows = [(i % 66 if i != 5 else None, t, 0) for i, t in enumerate(texts)] + [(3, texts[3], 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_bytes int").repartition(3)
    expected = removed_by_brute_force([(t or "").encode() for _, t, _ in rows], 40)
    expected = sorted((str(k), str(len((t or "").encode())), *map(str, e)) for (k, t, _), e in zip(rows, expected, strict=True))
    got = repeated_spans(docs, length=40, gram=8, hot=hot, owner_segments=owner)
    assert as_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


def test_long_texts_in_parts(spark, monkeypatch):
    from pricegrid.llm import substrings

    monkeypatch.setattr(substrings, "BLOCK", 128)
    r = random.Random(4)
    a, b = ("".join(r.choice("abcd") for _ in range(700)) for _ in range(2))
    texts = [a, b[:300] + a[200:333] + b[300:], "q" + a[600:]]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    bounds = np.cumsum([0] + [len(d) for d in data])
    covered = 0
    for _, start, inside, _ in substrings._pieces(bounds, 40):
        p0, _, p1, _, _ = substrings.segments(np.concatenate(data)[start : start + inside[-1]], inside, substrings.Powers(), 40, 8)
        covered += int((p1 - p0 + 1).sum())
    assert covered == sum(len(t) - 39 for t in texts)


def test_no_long_texts(odd_docs):
    got = repeated_spans(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert repeated_spans(odd_docs.limit(0)).count() == 0


def test_best_fit_takes_the_tightest_bin():
    assert best_fit([6, 5, 4, 3, 2], 10) == [0, 1, 0, 1, 1]
    assert best_fit([20, 3], 10) == [0, 1]
    assert best_fit([6, 6], 10, limit=1) is None
    r = random.Random(6)
    sizes = sorted((r.randrange(1, 500) for _ in range(3000)), reverse=True)
    bins, free = best_fit(sizes, 1000), []
    for size, b in zip(sizes, bins, strict=True):  # against a plain search
        fits = [f for f in free if f >= size]
        if fits:
            assert free[b] == min(fits)
            free[b] -= size
        else:
            assert b == len(free)
            free.append(1000 - size)


def test_packed_is_even():
    r = random.Random(9)
    sizes = [r.randrange(10, 300) for _ in range(2000)] + [20_000]
    loads = np.bincount(packed(sizes, 40), sizes, 40)
    rest = np.sort(loads)[:-1] if loads.max() == 20_000 else loads
    assert rest.max() - rest.min() <= 0.005 * rest.mean()
    assert packed([], 40) == [] and sorted(packed([5, 5], 3)) == [0, 1]


def test_shards(odd_docs):
    rows = sharded(odd_docs, shards=5).collect()
    texts = sorted(pairs(odd_docs), key=str)
    assert len(rows) == len(texts)
    raw = [(k, (t or "").encode()) for k, t in texts]
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(k), len(b) + 16, zlib.crc32(b)) for k, b in raw
    )
    groups = {}
    for r in rows:
        groups.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(g) == 1 for key, g in groups.items() if key[1] > 16)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sharded(odd_docs.limit(0)).count() == 0


def test_null_texts_do_not_meet_texts_that_name_their_id(spark):
    rows = [(5, None), (6, "no text 5"), (7, "x"), (5, None), (None, None), (8, ""), (9, "")]
    rows += [(10, "5"), (11, "\x005")]
    got = sharded(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=3).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(k) for k, _ in rows)
    shards = {}
    for r in got:
        shards.setdefault(r["doc_id"], set()).add(r["shard"])
    assert len(shards[5]) == 1 and shards[8] == shards[9]


def test_links_at_the_threshold_of_small_sets(spark):
    """Pairs of exactly 0.75: 3 of 4, 6 of 8 and 9 of 12 shingles, none may be missed."""
    r, rows = random.Random(12), []
    for pair in range(1500):
        for less, more in ((7, 8), (10, 12), (13, 16)):
            words = [f"w{r.randrange(10**9)}" for _ in range(more)]
            rows += [" ".join(words), " ".join(words[:less])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(4)
    got = {x["doc_id"]: x["component_id"] for x in near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(rows))] == [i - i % 2 for i in range(len(rows))]
