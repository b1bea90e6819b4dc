"""Near-duplicate documents by min-max hashing.

A document's set holds its distinct five-word shingles as 64-bit hashes. Under each
permutation both the minimum and the maximum of the set are kept, so PERMUTATIONS
hash evaluations give twice as many values, each agreeing with probability equal to
the similarity. Bands of four values make buckets; documents that meet are
candidates, and every link is confirmed on the full sets.

* Documents with equal sets are one node, so copies never meet in a bucket.
* In buckets of at most SMALL nodes all pairs are candidates; one meeting is enough.
* In larger buckets every node is compared with the bucket's pivot, the node that
  is in most large buckets. Nodes whose large buckets then still hold several
  components are compared exactly, in blocks that leave out blocks of one component.

A pair at the threshold meets in fifteen bands on average and is missed by all with
probability 2e-8 if minimum and maximum are independent, which needs sets of many
shingles. Of 3 against 4 shingles a simulation misses fewer than one in 400,000.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import importable, written
from .components import components
from .textbytes import LOWER, Powers, flat, mixed, word_hashes

SHINGLE = 5
PERCENT = 75
PERMUTATIONS = 96
ROWS = 4  # values of a band: minimum and maximum of two permutations
BANDS = PERMUTATIONS * 2 // ROWS
SMALL = 32
BLOCK = 256
_GROUP = 400  # texts whose signatures are made together

_RANDOM = np.random.Generator(np.random.PCG64(96))
_FLIP = _RANDOM.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)
_TIMES = _RANDOM.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, powers: Powers) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; empty without words."""
    data, bounds = flat(texts)
    hashes, at = word_hashes(LOWER[data], bounds, powers)
    out = []
    for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        size = min(SHINGLE, end - start)
        if not size:
            out.append(np.zeros(0, np.uint64))
            continue
        n = end - start - size + 1
        x = np.full(n, np.uint64(size))
        for k in range(size):
            x = x * _STEP + hashes[start + k : start + k + n]
        out.append(np.unique(mixed(x)))
    return out


def band_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """BANDS bucket hashes for each non-empty set."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    values = np.empty((len(sets), PERMUTATIONS * 2), np.uint64)
    for p in range(PERMUTATIONS):
        y = (x ^ _FLIP[p]) * _TIMES[p]
        values[:, 2 * p] = np.minimum.reduceat(y, starts)
        values[:, 2 * p + 1] = np.maximum.reduceat(y, starts)
    values = values.reshape(len(sets), BANDS, ROWS)
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), 1))
    for k in range(ROWS):
        out = mixed(out * _STEP + values[:, :, k])
    return out.view(np.int64)


def _sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for start in range(0, batch.num_rows, _GROUP):
            part = batch.slice(start, _GROUP)
            sets = shingle_sets(part["text"], powers)
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list[np.ndarray | None] = [None] * len(sets)
            for i, row in zip(full, band_hashes([sets[i] for i in full]) if full else [], strict=True):
                bands[i] = row
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    part["text_key"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_shingles", "digest", "bands"],
            )


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        kept = []
        for start in range(0, batch.num_rows, _GROUP):
            part = batch.slice(start, _GROUP)
            left, right = shingle_sets(part["text_a"], powers), shingle_sets(part["text_b"], powers)
            kept += [_linked(x, y) for x, y in zip(left, right, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _confirmed(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    text = keyed.select("text_key", "text")
    both = pairs.join(text.withColumnsRenamed({"text_key": "a", "text": "text_a"}), "a").join(
        text.withColumnsRenamed({"text_key": "b", "text": "text_b"}), "b"
    )
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify_batches, "a bigint, b bigint")


class _Groups:
    """Merged labels, for leaving out pairs that are already linked."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.parent.setdefault(x, x)) != x:
            self.parent[x] = self.parent[up]
            x = up
        return x

    def merge(self, x: int, y: int) -> None:
        self.parent[self.find(x)] = self.find(y)


def _compare_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the two sides of a pair of blocks (side 2: a block with itself)
    that tie different components."""
    sets = shingle_sets(pa.array(rows["text"], pa.string()), Powers())
    side, nodes, comp = rows["side"].to_numpy(), rows["node"].to_numpy(), rows["component"].to_numpy()
    right = np.flatnonzero(side != 0)
    groups, links = _Groups(), []
    if len(right):
        every = np.concatenate([sets[j] for j in right])
        owner = np.repeat(np.arange(len(right)), [len(sets[j]) for j in right])
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        sizes = np.array([len(sets[j]) for j in right])
        for i in np.flatnonzero(side != 1):
            low = np.searchsorted(every, sets[i], "left")
            n = np.searchsorted(every, sets[i], "right") - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(right))
            for j in np.flatnonzero(100 * both >= PERCENT * (len(sets[i]) + sizes - both)):
                x, y = int(comp[i]), int(comp[right[j]])
                if groups.find(x) != groups.find(y):
                    groups.merge(x, y)
                    links.append((int(nodes[i]), int(nodes[right[j]])))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _settled_links(stars: DataFrame, links: DataFrame, keyed: DataFrame) -> DataFrame | None:
    """Links between components that share large buckets, found in blocks."""
    cluster = components(stars).withColumnRenamed("component", "cluster")
    comp = components(links)
    nodes = written(
        cluster.join(comp, "node", "left").select("node", "cluster", F.coalesce("component", "node").alias("component")),
        "clusters",
    )
    parts = nodes.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    open_clusters = (
        parts.groupBy("cluster")
        .agg(F.count("*").alias("parts"), F.sum(F.when(F.col("n") < BLOCK, F.col("n")).otherwise(0)).alias("loose"))
        .where(F.col("parts") > 1)
    )
    parts = written(parts.join(open_clusters, "cluster"), "parts")
    if parts.isEmpty():
        return None
    pure = F.col("n") >= BLOCK
    slots = lambda n: F.ceil(n / BLOCK).cast("bigint")
    slot = F.when(pure, F.pmod(F.xxhash64("node"), slots(F.col("n")))).otherwise(
        F.pmod(F.xxhash64("component"), slots(F.col("loose")))
    )
    dealt = written(
        nodes.join(parts, ["cluster", "component"]).select(
            "node", "component", "cluster", F.when(pure, F.col("component")).alias("pure"), slot.alias("slot")
        ),
        "blocks",
    )
    blocks = dealt.select("cluster", "pure", "slot").distinct().select(
        "cluster", "pure", F.xxhash64("cluster", "pure", "slot").alias("block")
    )
    other = blocks.select("cluster", F.col("pure").alias("pure2"), F.col("block").alias("block2"))
    tasks = blocks.join(other, "cluster").where(
        (F.col("block") <= F.col("block2")) & ~F.coalesce(F.col("pure") == F.col("pure2"), F.lit(False))
    )
    tasks = tasks.select(F.xxhash64("block", "block2").alias("task"), "block", "block2")
    same = F.col("block") == F.col("block2")
    sides = tasks.select("task", "block", F.when(same, 2).otherwise(0).alias("side")).unionAll(
        tasks.where(~same).select("task", F.col("block2").alias("block"), F.lit(1).alias("side"))
    )
    members = dealt.withColumn("block", F.xxhash64("cluster", "pure", "slot")).join(
        keyed.select(F.col("text_key").alias("node"), "text"), "node"
    )
    return (
        members.join(sides, "block")
        .select("task", "side", "node", "component", "text")
        .groupBy("task")
        .applyInPandas(_compare_blocks, "a bigint, b bigint")
    )


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (doc_id, text, text_key); the key is the id, or a hash of the text without one."""
    importable(docs.sparkSession)
    keyed = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return keyed.withColumn("text_key", F.coalesce("doc_id", F.xxhash64("text")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", small: int = SMALL) -> DataFrame:
    """Per document: ``n_shingles``, ``component_id`` (smallest id reachable over
    links) and ``kept`` (it is that id itself).

    Documents without words have no shingles and are linked with nothing. Rows
    with one id count as one document; rows without an id are linked by their text
    and never name a component, and without any id around component_id is null and
    the row is kept. Repeated rows each get a row. Other columns are ignored.
    """
    return _labelled(_keyed(docs, key, text), small).select("doc_id", "n_shingles", "component_id").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", small: int = SMALL) -> DataFrame:
    """One document of each component, with all its columns: the one with the
    smallest id (of documents without ids, that with the smallest hash). Rows that
    share an id, or have none and equal texts, are one document."""
    labelled = _labelled(_keyed(docs, key, text), small)
    chosen = labelled.where(F.col("text_key") == F.coalesce("component_id", "component", "text_key"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.coalesce(F.col(f"`{key}`").cast("bigint"), F.xxhash64(F.col(f"`{text}`").cast("string"))).alias("text_key"))
    return (
        rows.join(chosen.select("text_key").distinct(), "text_key", "left_semi")
        .dropDuplicates(["text_key"])
        .select("row.*")
    )


def _labelled(keyed: DataFrame, small: int) -> DataFrame:
    """Per row doc_id, text_key, n_shingles, component (null without words) and
    component_id."""
    signed = written(
        keyed.mapInArrow(
            _sign_batches, "doc_id bigint, text_key bigint, n_shingles bigint, digest binary, bands array<bigint>"
        ),
        "signatures",
    )
    worded = signed.where("n_shingles > 0")
    classes = written(
        worded.groupBy("digest")
        .agg(F.min(F.struct("text_key", "n_shingles", "bands")).alias("one"), F.min("doc_id").alias("least_id"))
        .select("digest", "least_id", F.col("one.text_key").alias("node"), "one.n_shingles", "one.bands"),
        "classes",
    )
    rows = classes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    met = written(rows.join(sizes, "bucket"), "buckets")

    few = met.where(F.col("m") <= small).select("bucket", "node", "n")
    other = few.select("bucket", F.col("node").alias("b"), F.col("n").alias("n2"))
    close = 100 * F.least("n", "n2") >= PERCENT * F.greatest("n", "n2")
    pairs = (
        few.withColumnRenamed("node", "a")
        .join(other, "bucket")
        .where((F.col("a") < F.col("b")) & close)
        .select("a", "b")
    )

    many = met.where(F.col("m") > small)
    score = many.groupBy("node").agg(F.sum("m").alias("score"))
    tops = many.join(score, "node").groupBy("bucket").agg(F.max(F.struct("score", "node", "n")).alias("top"))
    # Written, so that the join below is free to split a large bucket.
    pivots = written(tops.select("bucket", F.col("top.node").alias("pivot"), F.col("top.n").alias("n2")), "pivots")
    stars = written(
        many.join(pivots, "bucket")
        .where(F.col("node") != F.col("pivot"))
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"), close.alias("close"))
        .distinct(),
        "stars",
    )
    links = written(_confirmed(pairs.unionAll(stars.where("close").select("a", "b")).distinct(), keyed), "links")
    found = links
    if not stars.isEmpty():
        more = _settled_links(stars, links, keyed)
        if more is not None:
            found = links.unionAll(written(more, "links"))
    comp = components(found)
    labelled = classes.select("digest", "least_id", "node").join(comp, "node", "left").select(
        "digest", "least_id", F.coalesce("component", "node").alias("component")
    )
    named = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    final = labelled.join(named, "component").select("digest", "component", "component_id")
    out = signed.drop("bands").join(final, "digest", "left")
    component_id = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_key", "n_shingles", "component", component_id.alias("component_id"))
