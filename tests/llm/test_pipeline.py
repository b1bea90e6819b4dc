"""The pipeline's stages against brute force, one after the other."""

import hashlib
import random
import re
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import normal
from conftest import pairs
from pricegrid.llm.secrets import RULES, redacted
from test_groups import linked_components
from test_scans import SECRETS, counts_of, item_words, spans_of

FOLDER = Path("/root/testdata/sf0.001")


def hidden(text):
    out, at = "", 0
    for start, order, end in spans_of(text, RULES):
        if start >= at:
            out += text[at:start] + f"[{RULES[order].kind}]"
        at = max(at, end)
    return out + text[at:]


def test_redacted(spark, odd_docs):
    rows = [(i, t, "s", len(t or "")) for i, t in enumerate([*SECRETS, None, ""])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, found string, n_chars int")
    got = redacted(docs)
    assert got.schema.names == docs.schema.names and got.dtypes == docs.dtypes
    for r in got.collect():
        before = rows[r["doc_id"]][1]
        assert r["text"] == (None if before is None else hidden(before))
        assert r["n_chars"] == (None if before is None else len(r["text"]))
    assert redacted(odd_docs).columns == odd_docs.columns


def test_pipeline(spark, tmp_path):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    item = " ".join(word() for _ in range(14))
    texts = [" ".join(word() for _ in range(r.randrange(10, 60))) for _ in range(60)]
    texts += [t + " more" for t in texts[:20]] + texts[20:25]
    texts += [f"{t} {item} end" for t in texts[:3]] + [f"{t} {s}" for t, s in zip(texts[30:], SECRETS, strict=False)]
    texts += ["", None, "one two " * 40, "Word|||%%% " * 30]
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, str(tmp_path))
    assert good.dtypes == docs.dtypes
    good_ids = {k for k, _ in pairs(good)}
    for key, text in pairs(docs):  # fences only reach texts with long words or symbols
        n, chars, symbols, _, repeated = counts_of(text)
        failed = n < 20 or 100 * repeated > 30 * n
        assert key not in good_ids if failed or symbols > n else key in good_ids or chars > 8 * n
    _, label = linked_components(pairs(good))
    kept = {k: t for k, t in pairs(good) if label[k] == k}
    windows = {tuple(item_words(item)[i : i + 10]) for i in range(5)}
    for key, text in list(kept.items()):
        words = item_words(text)
        if any(tuple(words[i : i + 10]) in windows for i in range(len(words))):
            del kept[key]
    tokenizer, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), set()
    for key, text in kept.items():
        ids = tokenizer.encode(hidden(text), add_special_tokens=False).ids
        expected.add((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(x["doc_id"], x["n_tokens"], x["ids_sha256"]) for x in got} == expected and len(got) == len(expected)
    assert len(kept) < len(pairs(good))


def test_stages_take_odd_and_empty_documents(spark, odd_docs, tmp_path):
    spark.createDataFrame([(1, "x")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_docs, odd_docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_every_operator_has_one_query():
    for n in range(1, 11):
        assert len([q for q in queries() if re.match(rf"op{n}_", q)]) == 1
    assert "pipeline" in queries() and set(oracle_sql()) <= set(queries())


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", [q for q in oracle_sql() if q.startswith("op")])
def test_query_equals_its_twin(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = queries()[name](spark, str(FOLDER)).toPandas()
    twin = db.sql(oracle_sql()[name]).df()
    assert len(got) and normal(got[twin.columns]).equals(normal(twin))
