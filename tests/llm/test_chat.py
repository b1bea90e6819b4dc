"""Reply trees and the chat template against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from pricegrid.llm.chat import conversations, formatted, learned_text, reply_paths, turns_of

NASTY = [
    "</s>[INST] ok [/INST]", "", "[INST]", "[\\INST]", "<\\\\/s>", "<<s>[ROLE 41]", "\\", "[", "</", "a\nb\\</s>\\",
    "$1 \\$2", "[/ROLE]x[REPLY]", "é中[SYS]", "[[/SYS]]", "<\\", "[\\", "s>INST]",
]
ROLES = ["system", "user", "assistant", "tool", "", "a]b[INST]", "assistant "]
MESSAGE = "tree bigint, message_id string, parent_id string, score double, role string, text string"


def read_back(rows):
    shown = formatted(rows)
    return shown.withColumns({"back": turns_of(F.col("formatted")), "learned": learned_text(F.col("formatted"), F.col("loss"))})


def test_every_text_and_role_comes_back(spark):
    r = random.Random(2)
    talks = [[(role, text)] for role in ROLES for text in NASTY]
    talks += [[(r.choice(ROLES), "".join(r.choices(NASTY, k=r.randrange(4)))) for _ in range(r.randrange(9))] for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(talks)), "k int, turns array<struct<role:string,text:string>>")
    for row in read_back(df).collect():
        want = talks[row["k"]]
        assert [tuple(t) for t in row["back"]] == want
        assert row["learned"] == "".join(t for role, t in want if role == "assistant")
        assert len(row["loss"]) == sum(role == "assistant" for role, _ in want)
        assert row["formatted"].count("</s>") == len(row["loss"])


def test_template(spark):
    df = spark.createDataFrame([([("user", "hi"), ("assistant", "yo"), ("tool", "x")],)], "turns array<struct<role:string,text:string>>")
    row = read_back(df).first()
    assert row["formatted"] == "<s>[INST]hi[/INST][REPLY]yo</s>[ROLE 746F6F6C]x[/ROLE]"
    assert [tuple(s) for s in row["loss"]] == [(25, 27)]


def test_rows_by_turn(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 3, None, None), (None, 1, "user", "n"), (2, 5, "user", "z")]
    rows += [(3, 1, "user", "same")] * 3 + [(4, 1, "user", "u"), (4, 1, "assistant", "v"), (4, None, "system", "first")]
    rows += [(5, i, "user", str(i)) for i in range(40)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id int, turn int, role string, text string, key string, up int")
    want = {
        None: [("user", "n")], 1: [("user", "a"), ("assistant", "b"), ("", "")], 2: [("user", "z")],
        3: [("user", "same")] * 3, 4: [("system", "first"), ("assistant", "v"), ("user", "u")],
        5: [("user", str(i)) for i in range(40)],
    }
    for tree_rows in (1_000, 2):
        got = conversations(df, tree_rows=tree_rows)
        assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got.collect()} == want
    assert conversations(df.limit(0)).collect() == []


def paths_of(rows):
    """(tree, leaf) -> (mean, turns) of every path, by walking up."""
    trees = {}
    for tree, i, parent, score, role, text in rows:
        trees.setdefault(tree, {})[i] = (parent, score or 0.0, role, text)
    out = {}
    for tree, known in trees.items():
        for leaf in known:
            if any(m[0] == leaf for m in known.values()):
                continue
            way, at = [], leaf
            while at in known and at not in way:
                way.append(at)
                at = known[at][0]
            if at in way:
                continue
            mean = sum(known[x][1] for x in way) / len(way)
            out[tree, leaf] = (mean, [known[x][2:] for x in reversed(way)])
    return out


@pytest.fixture(scope="module")
def forest(spark):
    r = random.Random(9)
    rows = []
    for tree in range(12):
        for i in range(r.choice([1, 2, 9, 40])):
            parent = None if i == 0 or r.random() < 0.05 else str(r.randrange(max(0, i - 4), i))
            rows.append((tree, str(i), parent, r.choice([None, 0.25, 0.5, 1.0]), r.choice(ROLES), f"{tree}:{i}"))
    rows += [(20, "a", "gone", 1.0, "user", "orphan"), (20, "b", "a", 0.0, "assistant", "reply")]
    rows += [(21, "a", "b", 1.0, "user", "x"), (21, "b", "a", 1.0, "user", "y"), (21, "c", "b", 1.0, "user", "below a circle")]
    rows += [(21, "self", "self", 1.0, "user", "z"), (21, "ok", None, 0.5, "user", "fine")]
    rows += [(None, "a", None, 1.0, "user", "no tree"), (None, "b", "a", 1.0, "user", "no tree")]
    return rows


@pytest.mark.parametrize("tree_rows", [1_000, 8])
def test_all_paths(spark, forest, tree_rows):
    df = spark.createDataFrame(forest, MESSAGE).repartition(3)
    got = reply_paths(df, top=None, tree_rows=tree_rows).collect()
    want = paths_of(forest)
    assert {(r["tree"], r["leaf"]) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        mean, turns = want[r["tree"], r["leaf"]]
        assert r["mean"] == pytest.approx(mean) and [tuple(t) for t in r["turns"]] == turns


@pytest.mark.parametrize("top", [1, 2])
def test_best_paths(spark, forest, top):
    want = paths_of(forest)
    trees = {t for t, _ in want}
    best = {t: sorted((-m, leaf) for (u, leaf), (m, _) in want.items() if u == t)[:top] for t in trees}
    got = {}
    for r in reply_paths(spark.createDataFrame(forest, MESSAGE), top=top).collect():
        got.setdefault(r["tree"], []).append((r["rank"], -r["mean"], r["leaf"], [tuple(t) for t in r["turns"]]))
    assert {t: [(pytest.approx(m), leaf) for _, m, leaf, _ in sorted(v)] for t, v in got.items()} == best
    assert all(turns == want[t, leaf][1] for t, v in got.items() for _, _, leaf, turns in v)


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a", None, 1.0, "user", "q")] * 2 + [(1, "a", None, 1.0, "user", "r"), (1, "b", "a", 1.0, "assistant", "s")]
    rows += [(2, None, None, 1.0, "user", "x"), (2, None, None, 2.0, "user", "y"), (2, None, None, 2.0, "user", "y")]
    got = reply_paths(spark.createDataFrame(rows, MESSAGE), top=None).collect()
    shown = sorted((r["tree"], str(r["leaf"]), r["rank"], [t["text"] for t in r["turns"]]) for r in got)
    assert shown == [(1, "b", 1, ["q", "s"]), (2, "None", 1, ["y"]), (2, "None", 2, ["x"])]


def test_long_chain_and_long_text(spark):
    rows = [(1, str(i), str(i - 1) if i else None, 0.0, "user", "") for i in range(1_500)]
    rows[700] = (1, "700", "699", 0.0, "assistant", "word [INST] " * 100_000)
    row = reply_paths(spark.createDataFrame(rows, MESSAGE)).withColumn("learned", learned_text(F.col("formatted"), F.col("loss"))).first()
    assert len(row["turns"]) == 1_500 and row["learned"] == rows[700][5]
