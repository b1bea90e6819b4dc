"""Token shards, tree BPE and the wavelet matrix against the plain library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import as_rows, pairs, some_texts
from pricegrid.llm.bpe import TreeEncoder, encoded, encoded_digests
from pricegrid.llm.tokenfile import WordEncoder, matrix_of, read_tokens, write_tokens
from pricegrid.llm.wavelet import WaveletMatrix

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 7, 64, 5000])
def test_wavelet_answers(n):
    ids = np.random.Generator(np.random.PCG64(n)).integers(0, 40, n)
    m = WaveletMatrix.build(ids, 6)
    assert m.decode().tolist() == ids.tolist()
    for i in range(0, n, max(1, n // 50)):
        assert m.access(i) == ids[i]
        assert m.rank(int(ids[i]), i) == int((ids[:i] == ids[i]).sum())
    for token in (0, 3, 39, 63):
        places = np.flatnonzero(ids == token).tolist()
        assert m.count(token) == len(places)
        assert [m.select(token, k) for k in range(0, len(places), 9)] == places[::9]
    with pytest.raises(IndexError):
        m.select(63, 0)


def test_word_encoder_equals_library():
    tokenizer, r = Tokenizer.from_file(BYTES), random.Random(2)
    made = ["".join(r.choice(" \n\tab'sé.1 ") for _ in range(r.randrange(40))) for _ in range(2000)]
    texts = [t or "" for t in some_texts()] + made
    got = WordEncoder(BYTES, cache=50).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("shard", [50, 10**9])
def test_token_files(spark, odd_docs, shard):
    tokenizer = Tokenizer.from_file(BYTES)
    shards = write_tokens(odd_docs, BYTES, shard_tokens=shard)
    rows = read_tokens(shards).orderBy("start").collect()
    docs = sorted(pairs(odd_docs), key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or ""))
    assert [r["doc_id"] for r in rows] == [d[0] for d in docs]
    at = 0
    for row, (_, text) in zip(rows, docs, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row["start"], row["n_tokens"]) == (at, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    shard_row = shards.orderBy("part", "seq").first()
    m = matrix_of(shard_row)
    assert [m.access(i) for i in range(5)] == m.decode()[:5].tolist()


@pytest.mark.parametrize("leaf", [1, 3, 48])
def test_tree_bpe_equals_library(leaf):
    tokenizer, e, r = Tokenizer.from_file(WORDS), TreeEncoder(WORDS, leaf, cache=40), random.Random(leaf)
    for _ in range(700):
        letters = r.choice(["ab", "a", "the ofin", "éèöab", "aA1 \n's.", "İΣx", "!?.", "中文a"])
        text = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 5, 30, 200])))
        text += r.choice(["", "<|endoftext|>", " <|startoftext|>x"])
        ids, decoded = e.encode([text, "x"])[0]
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert decoded == tokenizer.decode(expected, skip_special_tokens=False)


def test_encoded_digests(odd_docs):
    tokenizer = Tokenizer.from_file(WORDS)
    expected = []
    for key, text in pairs(odd_docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        digest = lambda b: hashlib.sha256(b).hexdigest()
        expected.append((str(key), str(len(ids)), digest(np.array(ids, "<u4").tobytes()), digest(decoded.encode())))
    got = encoded_digests(odd_docs, WORDS)
    assert as_rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected)
    assert encoded(odd_docs, WORDS).count() == len(expected)


def test_no_documents(odd_docs):
    none = odd_docs.limit(0)
    assert read_tokens(write_tokens(none, BYTES)).count() == 0
    assert encoded_digests(none, WORDS).count() == 0
