"""Spelling variants: words one edit apart, found with blocked Gram matrices.

A word is a vector of letter counts. One replaced code point moves it by a squared
distance of two, one inserted or deleted by one, so only pairs at most two apart need
to be looked at. The distances between two blocks of words are a product of their
count matrices, |x|^2 + |y|^2 - 2 x.y, and the few pairs left are verified in full.

Words are dealt into cells by length and by how many of their letters are in each of
three classes. One edit changes each of these numbers by at most one, so a cell is
only compared with itself and its neighbours, cells of equal or adjacent length. A cell
of more than BLOCK words is cut into blocks by hash, and each pair of blocks is one
task of bounded size that emits only verified pairs. Every pair of neighbouring blocks
is compared: nothing is left out at any size.

Words are counted in the tasks that read the texts, so that a frequent word is one row
per task and not one per occurrence.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import texts, written

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5  # a form is this many times as frequent as its variant
TYPO_EVERY = 199
BLOCK = 2_048
DIMENSIONS = 96
_CLASSES = ("aeiou", "bcdfghjklm")  # all other letters are the third class
_HELD = 400_000  # words a task holds before it hands them on
_CELLS = 4_000_000  # code points compared at a time

_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def runs_of(text: str | None) -> list[str]:
    """Maximal runs of letters, A-Z in lower case."""
    return _RUN.findall((text or "").encode().translate(_LOWER).decode())


def _count_batches(least: int, typo_every: int):
    def handed(found: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        for batch in batches:
            for key, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                start = zlib.crc32(f"{key or ''}:".encode())
                for word, n in Counter(runs_of(text)).items():
                    if typo_every:
                        h = zlib.crc32(word.encode(), start)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= least:
                        found[word] = found.get(word, 0) + n
                if len(found) > _HELD:
                    yield handed(found)
                    found = {}
        yield handed(found)

    return run


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    typo_every: int = 0,
) -> DataFrame:
    """Words of at least ``least`` code points that occur ``min_count`` times or more
    in all texts, as (word, n).

    ``typo_every`` plants typing errors: a run loses a code point where that number
    divides the checksum of its document and itself, in all its occurrences there. A
    null text has no words, a null id is an empty one, repeated rows count again, and
    other columns are ignored.
    """
    rows = texts(docs, key, text).withColumn("doc_id", F.col("doc_id").cast("string"))
    counted = rows.mapInArrow(_count_batches(least, typo_every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _codes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and where each word starts (and the last one ends)."""
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), bounds


def letter_counts(words: np.ndarray) -> np.ndarray:
    """Words by letters. a-z and U+00C0 to U+00FF have a column each; other code points
    share columns, which can only bring words closer together."""
    codes, bounds = _codes(words)
    letter = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % (DIMENSIONS - 26))
    row = np.repeat(np.arange(len(words)), np.diff(bounds))
    counts = np.bincount(row * DIMENSIONS + letter, minlength=len(words) * DIMENSIONS)
    exact = np.float32 if len(codes) == 0 or np.diff(bounds).max() < 2_000 else np.float64
    return counts.reshape(len(words), DIMENSIONS).astype(exact)


def one_edit(words: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words i and j differ by exactly one inserted, deleted or replaced code
    point: what their common prefix and common suffix leave over decides."""
    codes, bounds = _codes(words)
    size = np.diff(bounds)
    swap = size[i] > size[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    out = np.zeros(len(i), bool)
    step = max(1, _CELLS // max(1, int(size.max(initial=1))))
    for start in range(0, len(i), step):
        a, b = i[start : start + step], j[start : start + step]
        short, gap = size[a], size[b] - size[a]
        k = np.arange(short.max(initial=0))
        inside = k < short[:, None]

        def run(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            """Equal code points from the start of both."""
            same = inside & (codes[np.where(inside, first, 0)] == codes[np.where(inside, second, 0)])
            return np.logical_and.accumulate(same, axis=1).sum(axis=1)

        prefix = run(bounds[a][:, None] + k, bounds[b][:, None] + k)
        suffix = run(bounds[a + 1][:, None] - 1 - k, bounds[b + 1][:, None] - 1 - k)
        left = short - prefix - suffix
        out[start : start + step] = np.where(gap == 0, left == 1, (gap == 1) & (left <= 0))
    return out


def _compare_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """Near words of two blocks (sides 0 and 1), or of one block with itself (side 2)."""
    side, words, n = rows["side"].to_numpy(), rows["word"].to_numpy(), rows["n"].to_numpy()
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    counts = letter_counts(words)
    square = (counts * counts).sum(axis=1)
    distance = counts[left] @ counts[right].T
    distance *= -2
    distance += square[left][:, None]
    distance += square[right][None, :]
    x, y = np.nonzero(distance <= 2)
    i, j = left[x], right[y]
    fresh = (side[i] != 2) | (i < j)
    i, j = i[fresh], j[fresh]
    near = one_edit(words, i, j)
    i, j = i[near], j[near]
    return pd.DataFrame({"word": words[i], "n": n[i], "near": words[j], "near_n": n[j]})


def _steps() -> Column:
    """Half of the ways in which one edit can move a word to another cell; the other
    half are their opposites."""
    unit = [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
    moved = [tuple(a - b for a, b in zip(unit[p], unit[q], strict=True)) for p in range(3) for q in range(p)]
    steps = [(0, 0, 0), *unit, *moved]
    return F.array(*[F.struct(F.lit(sum(s)).alias("d0"), F.lit(s[0]).alias("d1"), F.lit(s[1]).alias("d2")) for s in steps])


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """All pairs of the distinct words (word, n) that are one edit apart, each pair once:
    (word, n, near, near_n). Null words are near to nothing."""
    in_class = [F.length("word") - F.length(F.translate("word", c, "")) for c in _CLASSES]
    cell = ["c0", "c1", "c2"]
    known = words.where(F.col("word").isNotNull())
    celled = written(known.select("word", "n", F.length("word").alias("c0"), *[c.alias(f"c{i + 1}") for i, c in enumerate(in_class)]), "words")
    cells = written(
        celled.groupBy(*cell).agg(F.ceil(F.count("*") / block).cast("int").alias("slots")), "word-cells"
    )
    name = lambda c, slot: F.concat_ws(".", *[F.col(x) for x in c], F.col(slot))
    placed = celled.join(cells, cell).withColumn("slot", F.pmod(F.xxhash64("word"), F.col("slots")))
    placed = placed.select("word", "n", name(cell, "slot").alias("block"))

    other = ["o0", "o1", "o2"]
    moved = cells.withColumn("d", F.explode(_steps())).select(
        *cell, "slots", *[(F.col(c) + F.col(f"d.d{i}")).alias(o) for i, (c, o) in enumerate(zip(cell, other, strict=True))]
    )
    beside = moved.join(cells.select(*[F.col(c).alias(o) for c, o in zip(cell, other, strict=True)], F.col("slots").alias("slots2")), other)
    tasks = beside.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).withColumn(
        "slot2", F.explode(F.sequence(F.lit(0), F.col("slots2") - 1))
    )
    tasks = tasks.select(name(cell, "slot").alias("block"), name(other, "slot2").alias("block2"), "slot", "slot2")
    own = F.col("block") == F.col("block2")
    same_cell = F.substring_index("block", ".", 3) == F.substring_index("block2", ".", 3)
    tasks = tasks.where(~same_cell | (F.col("slot") <= F.col("slot2"))).withColumn("task", F.concat_ws("|", "block", "block2"))
    sides = tasks.select("task", "block", F.when(own, 2).otherwise(0).alias("side")).unionAll(
        tasks.where(~own).select("task", F.col("block2").alias("block"), F.lit(1).alias("side"))
    )
    return (
        placed.join(written(sides, "word-blocks"), "block")
        .select("task", "side", "word", "n")
        .groupBy("task")
        .applyInPandas(_compare_blocks, "word string, n bigint, near string, near_n bigint")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, by doubling the steps followed. A form is
    more frequent than its word, so no way leads back."""
    now = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(
            now.join(ahead, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """Per word (of distinct rows word, n): ``form``, the most frequent near word (ties:
    the first in code-point order) if it is at least ``ratio`` times as frequent, else
    null; ``root``, where the forms lead (the word itself without one); ``n``,
    ``n_near`` near words and ``form_n``. Without words there are no rows."""
    words = written(words.select("word", "n"), "counted-words")
    pairs = written(near_words(words, block), "near-words")
    links = pairs.select("word", "near", "near_n").unionAll(
        pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )
    best = links.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    often = -F.col("best.less") >= ratio * F.col("n")
    forms = written(
        words.join(best, "word", "left").select(
            "word",
            F.when(often, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(often, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    return forms.join(_roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
