"""Benchmark decontamination with one Aho-Corasick automaton.

Texts of test items and documents are normalised alike: A-Z become a-z, words are
runs of letters a-z, digits and characters beyond ASCII. A window is ten
consecutive words of an item (an item of fewer words is one window). All windows
form one automaton, and each document is scanned once; a match gives the words it
covers, and their places in the original text.

Documents are never shuffled. The items are collected in slices whose automaton
has a bounded number of nodes; a further slice is a further scan in the same job.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import texts

WINDOW = 10
NODES = 4_000_000  # bound on the characters of all windows of one automaton

# Separators become a space; other bytes stay, A-Z in lower case.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")

SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
SCHEMA = (
    "doc_id bigint, text string, n_words bigint, hits array<struct<start:bigint,end:bigint>>, items array<string>"
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def windows_of(text: str | None, size: int = WINDOW) -> set[bytes]:
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def _automaton(items: list[tuple[str | None, str | None]], size: int) -> ahocorasick.Automaton | None:
    found: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows_of(text, size):
            found.setdefault(window, set()).update([] if item is None else [item])
    if not found:
        return None
    automaton = ahocorasick.Automaton()
    for window, ids in found.items():
        automaton.add_word(f" {window.decode('latin-1')} ", (len(window), sorted(ids)))
    automaton.make_automaton()
    return automaton


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(automaton: ahocorasick.Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Runs [first, last) of hit words, and the items found."""
    line = f" {b' '.join(words).decode('latin-1')} "
    matches = list(automaton.iter(line))
    if not matches:
        return [], set()
    starts = np.concatenate([[1], 2 + np.cumsum([len(w) + 1 for w in words[:-1]], dtype=np.int64) - 1])
    runs, ids = [], set()
    for end, (length, found) in matches:
        first, last = np.searchsorted(starts, [end - length, end])
        runs.append((int(first), int(last)))
        ids.update(found)
    return _merged(runs), ids


def _scan_batches(items: list[tuple[str | None, str | None]], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(items, size)
        for batch in batches:
            counts, hits, found = [], [], []
            before = zip(batch["hits"].to_pylist(), batch["items"].to_pylist(), strict=True)
            for text, (runs, ids) in zip(batch["text"].to_pylist(), before, strict=True):
                words = words_of(text)
                more, new = _scan(automaton, words) if automaton and words else ([], set())
                runs = [(r["start"], r["end"]) for r in runs]
                counts.append(len(words))
                hits.append([{"start": a, "end": b} for a, b in _merged(runs + more)])
                found.append(sorted({*ids, *new}))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text"],
                    pa.array(counts, pa.int64()),
                    pa.array(hits, pa.list_(SPAN)),
                    pa.array(found, pa.list_(pa.string())),
                ],
                ["doc_id", "text", "n_words", "hits", "items"],
            )

    return run


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, digests, n_hit = [], [], []
        for text, runs, ids in zip(
            batch["text"].to_pylist(), batch["hits"].to_pylist(), batch["items"].to_pylist(), strict=True
        ):
            n_hit.append(sum(r["end"] - r["start"] for r in runs))
            digests.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
            places = []
            if runs:
                raw = text.encode()
                at = [m.span() for m in _WORD.finditer(raw.translate(_TABLE))]
                for r in runs:
                    a, b = at[r["start"]][0], at[r["end"] - 1][1]
                    start = len(raw[:a].decode())
                    places.append({"start": start, "end": start + len(raw[a:b].decode())})
            spans.append(places)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["n_words"],
                pa.array(n_hit, pa.int64()),
                pa.array(digests, pa.string()),
                batch["items"],
                pa.array(spans, pa.list_(SPAN)),
            ],
            ["doc_id", "n_words", "n_hit", "items_sha256", "items", "spans"],
        )


def _slices(items: DataFrame, size: int, nodes: int) -> list[list[tuple[str | None, str | None]]]:
    """The items in parts whose windows have at most about ``nodes`` characters."""
    weight = F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))
    parts = -(-items.agg(weight).first()[0] * size // nodes) or 1
    slot = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    return [
        [(r["item_id"], r["text"]) for r in items.where(slot == part).collect()] for part in range(parts)
    ]


def _items(benchmark: DataFrame, item_key: str, item_text: str) -> DataFrame:
    return benchmark.select(
        F.col(f"`{item_key}`").cast("string").alias("item_id"), F.col(f"`{item_text}`").alias("text")
    )


def _clean_batches(items: list[tuple[str | None, str | None]], text: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(items, size)
        for batch in batches:
            words = map(words_of, batch[text].to_pylist())
            hit = [bool(w and automaton and _scan(automaton, w)[0]) for w in words]
            yield batch.filter(pa.array([not h for h in hit], pa.bool_()))

    return run


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    nodes: int = NODES,
) -> DataFrame:
    """The documents in which no window of an item occurs, with all their columns."""
    for part in _slices(_items(benchmark, item_key, item_text), window, nodes):
        docs = docs.mapInArrow(_clean_batches(part, text, window), docs.schema)
    return docs


def contaminated_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    nodes: int = NODES,
) -> DataFrame:
    """Per document: ``n_words``, ``n_hit`` words inside a window of an item, the
    ``items`` found (ids as sorted strings, ``items_sha256`` their digest) and
    ``spans`` of hit text as code points of the original text.

    A null or empty text has no words. Items without words match nothing; an item
    without an id hits words but is not listed. Repeated documents each get a row.
    Other columns of either table are ignored.
    """
    out = texts(docs, key, text).select(
        "doc_id",
        "text",
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("array() :: array<struct<start:bigint,end:bigint>>").alias("hits"),
        F.expr("array() :: array<string>").alias("items"),
    )
    kind = dict(docs.dtypes)[key]
    schema = SCHEMA.replace("doc_id bigint", f"doc_id {kind}")
    for part in _slices(_items(benchmark, item_key, item_text), window, nodes):
        out = out.mapInArrow(_scan_batches(part, window), schema)
    return out.mapInArrow(
        _result,
        f"doc_id {kind}, n_words bigint, n_hit bigint, items_sha256 string, items array<string>,"
        " spans array<struct<start:bigint,end:bigint>>",
    ).withColumn("n_items", F.size("items").cast("bigint")).withColumn("contaminated", F.col("n_hit") > 0)
