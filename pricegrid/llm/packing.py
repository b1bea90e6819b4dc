"""Shards of near-equal bytes from indivisible groups, by best fit decreasing.

Documents with equal texts form a group. Groups far smaller than a shard are first
packed inside their own tasks, by best fit decreasing, into bundles of a small
capacity. The bundles and the large groups, whose number is bounded by the shards and
not by the documents, are then packed the same way into the smallest capacity
that needs no more than the wanted number of shards. The open bins stand in
a balanced tree by remaining capacity.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import written

SHARDS = 40
EXTRA_BYTES = 16
BUNDLES = 1_000  # bundles that make up one shard; at most twice as many items a shard
SLOT_ROWS = 1_000  # rows numbered together
_LEAF = 256


class BinTree:
    """Bins by remaining capacity in a tree of two levels: sorted leaves of bounded
    size below their largest entries, split when full."""

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.tops: list[tuple[int, int]] = [(1 << 62, 0)]

    def add(self, left: int, bin_id: int) -> None:
        at = bisect_left(self.tops, (left, bin_id))
        leaf = self.leaves[at]
        insort(leaf, (left, bin_id))
        if len(leaf) > _LEAF:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]
            self.tops.insert(at, leaf[half - 1])

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least capacity that is enough."""
        at = bisect_left(self.tops, (size, -1))
        while at < len(self.leaves):
            leaf = self.leaves[at]
            place = bisect_left(leaf, (size, -1))
            if place < len(leaf):
                found = leaf.pop(place)
                if not leaf and len(self.leaves) > 1 and at < len(self.leaves) - 1:
                    del self.leaves[at], self.tops[at]
                return found
            at += 1
        return None


def best_fit(sizes: list[int], capacity: int, limit: int | None = None) -> list[int] | None:
    """Bin of each size, the sizes being in decreasing order; None when more than
    ``limit`` bins would be needed. A size beyond the capacity gets its own bin."""
    tree, bins, out = BinTree(), 0, []
    for size in sizes:
        found = tree.take(size)
        if found is None:
            if bins == limit:
                return None
            left, bin_id, bins = max(0, capacity - size), bins, bins + 1
        else:
            left, bin_id = found[0] - size, found[1]
        if left:
            tree.add(left, bin_id)
        out.append(bin_id)
    return out


def _evened(sizes: list[int], bins: list[int], count: int) -> list[int]:
    """Move items from the fullest bin to the emptiest while that helps, as the last
    bin of a best fit holds only what is left."""
    loads, held = [0] * count, [[] for _ in range(count)]
    for i, (size, b) in enumerate(zip(sizes, bins, strict=True)):
        loads[b] += size
        held[b].append((size, i))
    for h in held:
        h.sort()
    out = list(bins)
    for _ in range(100 * count):
        low = loads.index(min(loads))
        for high in sorted(range(count), key=lambda b: -loads[b])[:4]:
            gap = loads[high] - loads[low]
            at = bisect_left(held[high], (gap // 2 + 1, -1))
            near = [k for k in (at - 1, at) if 0 <= k < len(held[high]) and held[high][k][0] < gap]
            if near:
                size, i = held[high].pop(min(near, key=lambda k: abs(held[high][k][0] * 2 - gap)))
                insort(held[low], (size, i))
                loads[high] -= size
                loads[low] += size
                out[i] = low
                break
        else:
            break
    return out


def packed(sizes: list[int], shards: int) -> list[int]:
    """Shard of each size: an item of at least an even share has a shard of its own;
    the others fill the smallest capacity found that leaves no more shards."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    out, rest, alone = [0] * len(sizes), sum(sizes), 0
    while alone < min(len(order), shards - 1) and sizes[order[alone]] * (shards - alone) >= rest:
        out[order[alone]] = alone
        rest -= sizes[order[alone]]
        alone += 1
    order, bins = order[alone:], shards - alone
    if not order:
        return out
    tail = [sizes[i] for i in order]
    low = max(-(-rest // bins), tail[0])
    high, best = low, None
    while best is None:  # an answer first, then a smaller one
        best = best_fit(tail, high, bins)
        low, high = (low, high) if best else (high, high + max(1, high // 200))
    for _ in range(8):
        middle = (low + high) // 2
        if middle in (low, high):
            break
        found = best_fit(tail, middle, bins)
        low, high, best = (low, middle, found) if found else (middle, high, best)
    for i, b in zip(order, _evened(tail, best, bins), strict=True):
        out[i] = alone + b
    return out


def _bundle_batches(capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups = pd.concat([pd.DataFrame({"key": [], "bytes": []}), *batches])
        if groups.empty:
            return
        groups = groups.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
        bins = best_fit(groups["bytes"].astype("int64").tolist(), capacity)
        yield pd.DataFrame(
            {"key": groups["key"], "bytes": groups["bytes"].astype("int64"), "task": TaskContext.get().partitionId(), "bundle": bins}
        )

    return run


def _numbered(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """Gapless ``slot`` in each shard, numbered by buckets of rows in parallel."""
    buckets = max(1, -(-total // (shards * SLOT_ROWS)))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        dealt.withColumn("inside", F.row_number().over(inside))
        .join(before, ["shard", "bucket"])
        .withColumn("slot", (F.col("before") + F.col("inside") - 1).cast("bigint"))
    )


def sharded(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Per document ``size`` (UTF-8 bytes plus 16), ``text_crc32``, ``law``
    ('bytes'), ``shard``, ``slot`` and ``grown_shard`` (null under this law).

    A null text has no bytes and groups with null texts of its id only; empty texts are
    equal texts. A
    group of at least an even share fills a shard alone. With fewer groups than shards
    some shards are empty. Repeated rows each get a slot; other columns are ignored.
    """
    text_col = F.col(f"`{text}`").cast("string")
    key_col = F.col(f"`{key}`")
    # The first byte tells ids from texts, whatever a text says.
    digest = lambda kind, value: F.concat(F.lit(kind), F.unhex(F.sha2(value, 256)))
    alone = digest(b"\x00", F.coalesce(key_col.cast("string"), F.lit("")))
    sized = written(
        docs.select(
            key_col.alias("doc_id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + EXTRA_BYTES).cast("bigint").alias("size"),
            F.crc32(F.coalesce(text_col, F.lit("")).cast("binary")).alias("text_crc32"),
            F.when(text_col.isNull(), alone).otherwise(digest(b"\x01", text_col)).alias("key"),
        ),
        "sized",
    )
    total, rows = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    capacity = max(1, total // (shards * BUNDLES))
    groups = sized.groupBy("key").agg(F.sum("size").alias("bytes"))
    bundled = written(
        groups.mapInPandas(_bundle_batches(capacity), "key binary, bytes bigint, task int, bundle int"), "bundles"
    )
    # At most two items a bundle's worth of bytes, and one a task.
    items = bundled.groupBy("task", "bundle").agg(F.sum("bytes").alias("bytes")).orderBy("task", "bundle").collect()
    chosen = packed([i["bytes"] for i in items], shards)
    table = docs.sparkSession.createDataFrame(
        [(i["task"], i["bundle"], s) for i, s in zip(items, chosen, strict=True)], "task int, bundle int, shard int"
    )
    placed = sized.join(
        bundled.join(F.broadcast(table), ["task", "bundle"]).select("key", "shard"), "key"
    )
    return _numbered(placed, rows, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
