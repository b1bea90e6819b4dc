"""Fill-in-the-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` keeps the end of every repetition of its group:
their number is the number of units, and the ends at the two drawn places are the
offsets of both cuts, so a text is not walked unit by unit. By default a unit is a
code point; any pattern that never matches empty text will do (``\\X``, ``\\w+\\W*``).

A match holds about 110 bytes for each unit (measured). Texts above LONG code points
are therefore matched over windows of that size, one after another: the counts of the
windows give the number of units, and a second pass over them finds the cuts, which
are those of a single match.

Rows are independent: no shuffle, and a lost task repeats only its own rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import texts

UNIT = r"(?s:.)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
KEEP_PERCENT = 90  # texts that are cut; the others stay plain
SPM_PERCENT = 20  # cut texts whose suffix comes first
SEED = "1"
LONG = 500_000
_GROUP = 64  # texts a batch of output


class Units:
    """Places between the units of a text."""

    def __init__(self, unit: str = UNIT, long: int = LONG) -> None:
        self.pattern = regex.compile(f"({unit})*")
        self.long = long

    def _windows(self, text: str) -> Iterator[list[int]]:
        """Ends of the units, by windows. The last unit of a window may go on behind
        it, so the next window starts with that unit."""
        at = 0
        while at < len(text):
            size = self.long
            while True:
                whole = at + size >= len(text)
                match = self.pattern.match(text, at) if whole else self.pattern.match(text, at, at + size)
                ends = match.ends(1) if whole else match.ends(1)[:-1]
                if ends or whole:
                    break
                size *= 2  # a unit longer than the window
            if not ends or whole and ends[-1] != len(text):
                raise ValueError("the unit does not match all of the text")
            yield ends
            at = ends[-1]

    def cut(self, text: str, places) -> tuple[int, list[int]]:
        """The number n of units and the offsets behind the ``places(n)`` units."""
        if len(text) <= self.long:
            match = self.pattern.fullmatch(text)
            if match is None:
                raise ValueError("the unit does not match all of the text")
            ends = match.ends(1)
            return len(ends), [ends[k - 1] if k else 0 for k in places(len(ends))]
        n = sum(map(len, self._windows(text)))
        wanted = places(n)
        found, before = {0: 0}, 0
        for ends in self._windows(text):
            found |= {k: ends[k - before - 1] for k in wanted if before < k <= before + len(ends)}
            before += len(ends)
        return n, [found[k] for k in wanted]


def draws(key: object, seed: str = SEED) -> list[int]:
    """Four numbers below 2^32 that depend on the seed and the key only."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _cut_batches(unit: str, keep: int, spm: int, seed: str, long: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(unit, long)
        for batch in batches:
            for start in range(0, batch.num_rows, _GROUP):
                part = batch.slice(start, _GROUP)
                rows = [
                    _one(key, text or "", units, keep, spm, seed)
                    for key, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True)
                ]
                n, form, prefix, middle, output = map(list, zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.string()),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def _one(key: object, text: str, units: Units, keep: int, spm: int, seed: str) -> tuple:
    h1, h2, h3, h4 = draws(key, seed)
    n, (first, last) = units.cut(text, lambda n: sorted((h1 % (n + 1), h2 % (n + 1))))
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= keep:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if h4 % 100 < spm:
        return n, "spm", first, last - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, last - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def infilled(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    unit: str = UNIT,
    keep_percent: int = KEEP_PERCENT,
    spm_percent: int = SPM_PERCENT,
    seed: str = SEED,
    long: int = LONG,
) -> DataFrame:
    """Per document ``n`` units, ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (code points; null if plain) and the ``output`` text.

    A null text is an empty one and stays plain, as does a text that holds a mark. The
    draws depend on the id and the seed, so repeated rows are cut alike and each get a
    row; rows without an id draw as the empty id. No rows give no rows. Other columns,
    whatever their names, are ignored.
    """
    rows = texts(docs, key, text)
    fields = [
        rows.schema["doc_id"],
        *[T.StructField(c, k()) for c, k in (
            ("n", T.LongType), ("form", T.StringType), ("prefix_chars", T.LongType),
            ("middle_chars", T.LongType), ("output", T.StringType),
        )],
    ]
    return rows.mapInArrow(_cut_batches(unit, keep_percent, spm_percent, seed, long), T.StructType(fields))


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from. Cut texts hold no marks, and no mark ends as
    another one starts, so the first mark of a kind is the one that was set."""
    second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    mid = F.lit(len(MIDDLE))

    def joined(b: Column) -> Column:
        one = F.position(second, b)
        two = F.position(F.lit(MIDDLE), b)
        left = F.substr(b, F.lit(1), one - 1)
        right = F.substr(b, one + mid, two - one - mid)
        middle = F.substr(b, two + mid)
        return F.when(form == "psm", F.concat(left, middle, right)).otherwise(F.concat(right, middle, left))

    return F.when(form == "plain", output).otherwise(joined(body))
