"""Removal of long repeated byte strings with merged runs of sorted suffixes.

Every string of LENGTH bytes has an anchor: the place of its smallest GRAM-byte hash.
As that depends on the string alone, equal strings have equal anchors. Consecutive
starts with one anchor form a segment, so repeated strings are found by
comparing segments with equal anchors instead of all suffixes of all texts.

* Segments that are equal as a whole are counted by hash; they are covered.
* The other segments of an anchor are sorted as suffixes from the anchor on. Tasks
  send front-coded sorted runs to the owner of their range of anchors, which merges
  them with a loser tree. The shared prefixes it gives, and those of the texts before
  the anchor, say how far two segments agree to both sides; from LENGTH bytes on,
  all of that is covered.
* Anchors with more than HOT different segments never meet in a task: their starts
  are compared by hashes of all LENGTH bytes, with counts that are summed before they
  are shuffled.

Hash pairs of 64 bits each stand for equal strings; a chance match among 10^12
segments has a probability below 10^-14.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import written
from .key_filter import bitmap, passes, passing
from .suffix_merge import front_coded, merged, shared_prefix
from .textbytes import Powers, flat, mixed, prefix_hash

LENGTH = 400
GRAM = 48
HOT = 4_000
BLOCK = 1 << 20  # bytes of text looked at together
OWNER_SEGMENTS = 10_000  # segments an owner of anchors merges, on average
_PLACE = np.uint64((1 << 24) - 1)
_TIMES = 0x9E3779B97F4A7C15
_BACK = pow(_TIMES, -1, 1 << 64)
SEGMENT = "d bigint, k bigint, p0 int, a int, p1 int, ah bigint, ch bigint"


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """Minimum of each run of ``window`` values."""
    n = len(values) - window + 1
    rows = -(-len(values) // window)
    padded = np.full(rows * window, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(rows, window)
    upto = np.minimum.accumulate(padded, axis=1).ravel()
    since = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[:n], upto[window - 1 : window - 1 + n])


def segments(data: np.ndarray, bounds: np.ndarray, powers: Powers, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(p0, a, p1, ah, ch) of all segments, as places in ``data``; no string
    crosses the given bounds of texts."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 5
    prefix = prefix_hash(data, powers)
    n = len(data) - gram + 1
    hashes = mixed((prefix[gram:] - prefix[:n]) * powers.down[:n])
    best = _least((hashes & ~_PLACE) | np.arange(n, dtype=np.uint64), length - gram + 1)
    ok = np.zeros(len(best) + 1, np.int8)
    begins, ends = bounds[:-1], bounds[1:] - length + 1
    full = ends > begins
    np.add.at(ok, begins[full], 1)
    np.add.at(ok, ends[full], -1)
    ok = np.cumsum(ok[:-1]).astype(bool)
    new = np.ones(len(best), bool)
    new[1:] = (best[1:] != best[:-1]) | ~ok[:-1]
    p0 = np.flatnonzero(new & ok)
    last = np.ones(len(best), bool)
    last[:-1] = (best[1:] != best[:-1]) | ~ok[1:]
    p1 = np.flatnonzero(last & ok)
    a = (best[p0] & _PLACE).astype(np.int64)
    content = (prefix[p1 + length] - prefix[p0]) * powers.down[p0]
    shape = (a - p0).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (p1 - p0).astype(np.uint64)
    return p0, a, p1, hashes[a].view(np.int64), mixed(mixed(content) + shape).view(np.int64)


def _pieces(bounds: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, int]]:
    """(first text, start, bounds inside, start in the text): whole texts together, or
    parts of one long text that overlap by length - 1 bytes."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = i + 1
        while j < n and bounds[j + 1] - bounds[i] <= BLOCK:
            j += 1
        if bounds[j] - bounds[i] <= BLOCK:
            yield i, int(bounds[i]), bounds[i : j + 1] - bounds[i], 0
        else:
            for start in range(int(bounds[i]), int(bounds[i + 1]) - length + 1, BLOCK - length + 1):
                end = min(start + BLOCK, int(bounds[i + 1]))
                yield i, start, np.array([0, end - start]), start - int(bounds[i])
        i = j


def _segment_batches(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            d, k = batch["d"].to_numpy(), batch["k"].to_numpy()
            data, bounds = flat(batch["text"])
            for first, start, inside, before in _pieces(bounds, length):
                p0, a, p1, ah, ch = segments(data[start : start + inside[-1]], inside, powers, length, gram)
                text = np.searchsorted(inside, p0, "right") - 1
                shift = before - inside[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(d[first + text]),
                        pa.array(k[first + text]),
                        pa.array((p0 + shift).astype(np.int32)),
                        pa.array((a + shift).astype(np.int32)),
                        pa.array((p1 + shift).astype(np.int32)),
                        pa.array(ah),
                        pa.array(ch),
                    ],
                    ["d", "k", "p0", "a", "p1", "ah", "ch"],
                )

    return run


def _spread(ah: int) -> int:
    """An anchor's hash dealt evenly over 64 bits; as the smallest of many it is small."""
    return ah * _TIMES % (1 << 64)


def _gathered(spread: int) -> int:
    """The signed hash that ``_spread`` has dealt."""
    ah = spread * _BACK % (1 << 64)
    return ah - (1 << 64) if ah >> 63 else ah


def _run_batches(owners: int, length: int):
    """Front-coded sorted runs, one for each owner, of the wanted segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, bytes, int, bytes]] = []
            for text, wanted in zip(batch["text"].to_pylist(), batch["wanted"].to_pylist(), strict=True):
                raw = text.encode()
                for w in wanted:
                    anchor = _spread(w["ah"])
                    key = anchor.to_bytes(8, "big") + raw[w["a"] : w["p1"] + length]
                    rows.append((anchor * owners >> 64, key, w["ch"], raw[w["p0"] : w["a"]][::-1]))
            rows.sort()
            out: dict[str, list] = {c: [] for c in ("owner", "shared", "rests", "ch", "before")}
            at = 0
            while at < len(rows):
                end = at
                while end < len(rows) and rows[end][0] == rows[at][0]:
                    end += 1
                shared, rests = front_coded(r[1] for r in rows[at:end])
                for c, v in zip(out, (rows[at][0], shared, rests, [r[2] for r in rows[at:end]], [r[3] for r in rows[at:end]]), strict=True):
                    out[c].append(v)
                at = end
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["owner"], pa.int32()),
                    pa.array(out["shared"], pa.list_(pa.int32())),
                    pa.array(out["rests"], pa.list_(pa.binary())),
                    pa.array(out["ch"], pa.list_(pa.int64())),
                    pa.array(out["before"], pa.list_(pa.binary())),
                ],
                list(out),
            )

    return run


def _agreement(near: np.ndarray, i: int) -> np.ndarray:
    """Prefixes that the i-th of sorted strings shares with each of them, from those
    that neighbours share; none with itself."""
    out = np.zeros(len(near), np.int32)
    out[i + 1 :] = np.minimum.accumulate(near[i + 1 :])
    out[:i] = np.minimum.accumulate(near[i:0:-1])[::-1]
    return out


def _covered(group: list[tuple[bytes, int, bytes, int]], length: int) -> Iterator[tuple[int, int, int]]:
    """(ch, bytes before the anchor, bytes from it on) of covered segments; the group
    is in order, each with the prefix shared with the one before."""
    m = len(group)
    after = np.array([g[3] for g in group], np.int32)
    order = sorted(range(m), key=lambda i: group[i][2])
    shares = [shared_prefix(group[order[i - 1]][2], group[order[i]][2]) for i in range(1, m)]
    before = np.array([0, *shares], np.int32)
    back = np.empty(m, np.int64)
    back[order] = np.arange(m)
    ch = np.array([g[1] for g in group], np.int64)
    for i in range(m):
        high, low = _agreement(after, i), _agreement(before, int(back[i]))[back]
        both = (high + low >= length) & (ch != ch[i])
        if both.any():
            yield int(ch[i]), int(low[both].max()), int(high[both].max())


def _merge_owner(length: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        runs = list(zip([list(s) for s in rows["shared"]], [list(r) for r in rows["rests"]], strict=True))
        chs, befores = list(rows["ch"]), list(rows["before"])
        out: list[tuple[int, int, int, int]] = []
        group: list[tuple[bytes, int, bytes, int]] = []
        anchor = b""

        def close() -> None:
            if len(group) > 1:
                ah = _gathered(int.from_bytes(anchor, "big"))
                out.extend((ah, *c) for c in _covered(group, length))

        for r, at, text, shared in merged(runs):
            if text[:8] != anchor:
                close()
                group, anchor = [], text[:8]
            group.append((text, int(chs[r][at]), befores[r][at], max(0, shared - 8)))
        close()
        return pd.DataFrame(out, columns=["ah", "ch", "low", "high"], dtype="int64")

    return run


def _start_batches(length: int):
    """Hashes of all strings that start in the wanted segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for text, wanted in zip(batch["text"].to_pylist(), batch["wanted"].to_pylist(), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                for w in wanted:
                    part = data[w["p0"] : w["p1"] + length]
                    prefix = prefix_hash(part, powers)
                    n = len(part) - length + 1
                    g = mixed((prefix[length:] - prefix[:n]) * powers.down[:n])
                    same = np.ones(n, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(same * w["ah"]),
                            pa.array(same * w["ch"]),
                            pa.array(g.view(np.int64)),
                            pa.array(w["a"] - w["p0"] - np.arange(n)),
                        ],
                        ["ah", "ch", "g", "l"],
                    )

    return run


def _result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, spans, digests = [], [], []
        for text, digest, found in zip(
            batch["text"].to_pylist(), batch["digest"].to_pylist(), batch["found"].to_pylist(), strict=True
        ):
            runs: list[list[int]] = []
            for s in sorted((s["s"], s["e"]) for s in found or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            if digest is None:
                raw, at, kept = text.encode(), 0, hashlib.sha256()
                for a, b in runs:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                digest = kept.hexdigest()
            removed.append(sum(b - a for a, b in runs))
            spans.append([{"start": a, "end": b} for a, b in runs])
            digests.append(digest)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["n_bytes"], pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(spans, span)],
            ["doc_id", "n_bytes", "n_removed", "kept_sha256", "spans"],
        )


def repeated_spans(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT,
    owner_segments: int = OWNER_SEGMENTS,
) -> DataFrame:
    """Per document: ``n_bytes``, ``n_removed`` bytes covered by a string of
    ``length`` bytes that also starts elsewhere, the maximal removed runs (``n_spans``,
    ``spans`` as byte places) and ``kept_sha256`` of what remains.

    A null text is an empty one; shorter texts lose nothing. Repeated rows, whatever
    their ids, repeat each other's strings. Other columns are ignored.
    """
    keyed = docs.select(
        F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    ).select("doc_id", F.coalesce("doc_id", F.lit(-1)).alias("d"), F.xxhash64("text").alias("k"), "text")
    long = keyed.where(F.octet_length("text") >= length).select("d", "k", "text")
    every = written(long.mapInArrow(_segment_batches(length, gram), SEGMENT), "segments")
    twice = every.groupBy("ah").agg(F.count("*").alias("n")).where("n > 1")
    found = written(passing(every, "ah", bitmap(twice, "ah")), "segments")

    contexts = written(
        found.groupBy("ah", "ch").agg(F.count("*").alias("n"), F.min(F.struct("d", "k", "p0", "a", "p1")).alias("one")),
        "contexts",
    )
    shared = contexts.groupBy("ah").agg(F.count("*").alias("m")).where("m > 1")
    wanted = written(
        contexts.join(shared, "ah")
        .groupBy("one.d", "one.k")
        .agg(
            *[
                F.collect_list(F.when(kind, F.struct("ah", "ch", "one.p0", "one.a", "one.p1"))).alias(name)
                for name, kind in (("sorted", F.col("m") <= hot), ("hashed", F.col("m") > hot))
            ]
        )
        .withColumn("doc", F.xxhash64("d", "k")),
        "wanted",
    )
    n_sorted, n_hashed = wanted.agg(
        F.coalesce(F.sum(F.size("sorted")), F.lit(0)), F.coalesce(F.sum(F.size("hashed")), F.lit(0))
    ).first()
    full = contexts.where("n > 1").select(
        "ah", "ch", (F.col("one.a") - F.col("one.p0")).cast("bigint").alias("low"), (F.col("one.p1") + length - F.col("one.a")).cast("bigint").alias("high")
    )
    cover = full
    if n_sorted or n_hashed:
        held = passing(long.withColumn("doc", F.xxhash64("d", "k")), "doc", bitmap(wanted, "doc"))
        cut = written(held.drop("doc").join(wanted.drop("doc"), ["d", "k"]).select("text", "sorted", "hashed"), "texts")
        if n_sorted:
            owners = -(-n_sorted // owner_segments)
            runs = cut.where(F.size("sorted") > 0).select("text", F.col("sorted").alias("wanted")).mapInArrow(
                _run_batches(owners, length),
                "owner int, shared array<int>, rests array<binary>, ch array<bigint>, before array<binary>",
            )
            cover = cover.unionAll(
                runs.groupBy("owner").applyInPandas(_merge_owner(length), "ah bigint, ch bigint, low bigint, high bigint")
            )
        if n_hashed:
            starts = written(
                cut.where(F.size("hashed") > 0)
                .select("text", F.col("hashed").alias("wanted"))
                .mapInArrow(_start_batches(length), "ah bigint, ch bigint, g bigint, l bigint"),
                "starts",
            )
            again = starts.groupBy("ah", "g").agg(F.min("ch").alias("c1"), F.max("ch").alias("c2")).where("c1 <> c2")
            cover = cover.unionAll(
                starts.join(again.select("ah", "g"), ["ah", "g"])
                .groupBy("ah", "ch")
                .agg(F.max("l").alias("low"), (length - F.min("l")).alias("high"))
            )
    # Written, so that the join below is free to split segments with very many copies.
    cover = written(
        cover.groupBy("ah", "ch").agg(F.max("low").alias("low"), F.max("high").alias("high")), "cover"
    )
    spans = written(
        found.join(cover, ["ah", "ch"])
        .select("d", "k", F.struct((F.col("a") - F.col("low")).alias("s"), (F.col("a") + F.col("high")).alias("e")).alias("span"))
        .distinct()
        .groupBy("d", "k")
        .agg(F.collect_list("span").alias("found"))
        .withColumn("doc", F.xxhash64("d", "k")),
        "spans",
    )
    marked = _marked(keyed.withColumn("doc", F.xxhash64("d", "k")), bitmap(spans, "doc"))
    return marked.join(spans.drop("doc"), ["d", "k"], "left").select("doc_id", "n_bytes", "text", "digest", "found").mapInArrow(
        _result_batches,
        "doc_id bigint, n_bytes bigint, n_removed bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>",
    ).withColumn("n_spans", F.size("spans").cast("bigint"))


def _marked(keyed: DataFrame, words: np.ndarray) -> DataFrame:
    """Texts that may have spans as they are; of others only their digest."""
    shared = keyed.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = passes(shared.value, batch["doc"].to_numpy())
            texts = batch["text"].to_pylist()
            raw = [t.encode() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["d"],
                    batch["k"],
                    pa.array([len(r) for r in raw], pa.int64()),
                    pa.array([t if x else None for t, x in zip(texts, kept, strict=True)], pa.string()),
                    pa.array([None if x else hashlib.sha256(r).hexdigest() for r, x in zip(raw, kept, strict=True)], pa.string()),
                ],
                ["doc_id", "d", "k", "n_bytes", "text", "digest"],
            )

    return keyed.mapInArrow(run, "doc_id bigint, d bigint, k bigint, n_bytes bigint, text string, digest string")
