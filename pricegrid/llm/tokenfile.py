"""Token ids as wavelet-matrix shards, one compressed file each.

Documents are range-partitioned and sorted by id. A task encodes its documents and
writes a shard whenever it holds enough ids: the planes of a wavelet matrix with
their rank directories, the document ids and the lengths. A shard is one row and
one Parquet file with zstd pages, so any store that Spark can write holds it, and
one read answers access, counting and occurrence lookups.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from .bpe import groups
from .common import texts, written
from .wavelet import WaveletMatrix

END_ID = 0
SHARD_TOKENS = 6_000_000  # a shard is closed at the first document that passes it
CACHE = 1_000_000  # distinct pieces a Python worker remembers

_GROUP = 20_000_000  # characters encoded together
_JOINED = 200  # pieces encoded in one string
# White space that may share a token with the space before it.
_BLANK = r"[ \t-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

SHARD_SCHEMA = (
    "part int, seq int, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>,"
    " zeros array<bigint>, planes array<binary>, ranks array<binary>"
)


class WordEncoder:
    """Ids of texts, piece by piece with a memory for pieces.

    With the byte-level pre-tokenizer a space before other text always starts a
    token, so a text can be cut there. Texts where a space stands at an edge or before
    other white space, or that hold a special token, are encoded whole. Of the cut
    texts only pieces that are not remembered are encoded, many in one string: the
    bytes that each token stands for tell where a piece ends. Pieces and their ids are
    Arrow arrays throughout, so no piece becomes an object of its own.
    """

    def __init__(self, path: str, cache: int = CACHE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([r"\A ", r" \z", f" {_BLANK}", *special])
        self.known = pa.array([], pa.large_string())
        self.known_ids = pa.array([], pa.large_binary())
        self.cache_size = cache
        size = self.tokenizer.get_vocab_size()
        self.width = max(1, int(size - 1).bit_length())
        self.kind = "<u2" if self.width <= 16 else "<u4"
        # A character of a byte-level token stands for one byte.
        self.token_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)

    def _run(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in done]

    def _pieces(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of pieces, each with a space before it."""
        n = len(pieces)
        if not n:
            return pa.array([], pa.large_binary())
        size = np.dtype(self.kind).itemsize
        bounds = pa.array([*range(0, n, _JOINED), n], pa.int32())
        lines = pc.binary_join(pa.ListArray.from_arrays(bounds, pieces), pa.scalar(" ", pa.large_string()))
        ids = b"".join(self._run([f" {line}" for line in lines.to_pylist()]))
        ends = np.cumsum(pc.binary_length(pieces).to_numpy().astype(np.int64) + 1)
        cuts = np.zeros(n + 1, np.int64)
        token_ends = np.cumsum(self.token_bytes[np.frombuffer(ids, self.kind)])
        cuts[1:] = size * (np.searchsorted(token_ends, ends) + 1)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts), pa.py_buffer(ids)])

    def _remembered(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct pieces; when the memory is full only theirs stay in it."""
        at = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(pc.is_null(at))
        if len(self.known) + len(new) > self.cache_size:
            held = at.drop_null()
            self.known, self.known_ids = self.known.take(held), self.known_ids.take(held)
            at = pc.index_in(pieces, value_set=self.known)
        places = at.fill_null(-1).to_numpy().astype(np.int64)
        places[places < 0] = len(self.known) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, new])
        self.known_ids = pa.concat_arrays([self.known_ids, self._pieces(new)])
        return self.known_ids.take(pa.array(places))

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        rows = pa.array(texts, pa.large_string())
        is_whole = pc.match_substring_regex(rows, self.whole).to_numpy(zero_copy_only=False).astype(bool)
        whole = np.flatnonzero(is_whole).tolist()
        for i, ids in zip(whole, self._run([texts[i] for i in whole]), strict=True):
            out[i] = ids
        cut = np.flatnonzero(~is_whole)
        split = pc.split_pattern(rows.take(pa.array(cut)), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        pieces = split.flatten()
        coded = pc.dictionary_encode(pieces)
        known = self._remembered(coded.dictionary)
        heads = self._run(pieces.take(pa.array(bounds[:-1])).to_pylist())
        # Words by their number; a text's first piece, which has no space, by its text's.
        word = coded.indices.to_numpy().astype(np.int64)
        word[bounds[:-1]] = len(known) + np.arange(len(cut))
        taken = pa.concat_arrays([known, pa.array(heads, pa.large_binary())]).take(pa.array(word))
        _, ends, data = taken.buffers()
        ids = data.to_pybytes() if data is not None else b""
        ends = np.frombuffer(ends, np.int64)[: len(word) + 1][bounds] if len(word) else bounds
        for i, a, b in zip(cut.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[i] = ids[a:b]
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker, so its memory stays warm."""
    return WordEncoder(path)


def _shard(seq: int, ids: list[bytes], doc_ids: list[int | None], kind: str, width: int) -> pa.RecordBatch:
    size = int(kind[2])
    matrix = WaveletMatrix.build(np.frombuffer(b"".join(ids), kind), width)
    values = {
        "part": (TaskContext.get().partitionId(), pa.int32()),
        "seq": (seq, pa.int32()),
        "n_tokens": (matrix.n, pa.int64()),
        "doc_ids": (doc_ids, pa.list_(pa.int64())),
        "lengths": ([len(i) // size for i in ids], pa.list_(pa.int64())),
        "zeros": (matrix.zeros, pa.list_(pa.int64())),
        "planes": ([p.tobytes() for p in matrix.planes], pa.list_(pa.binary())),
        "ranks": ([r.astype("<u4").tobytes() for r in matrix.ranks], pa.list_(pa.binary())),
    }
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values.values()], list(values))


def _write_batches(path: str, shard_tokens: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([end_id], encoder.kind).tobytes()
        size = len(end)
        ids: list[bytes] = []
        keys: list[int | None] = []
        held = seq = 0
        for batch in batches:
            names = iter(batch["doc_id"].to_pylist())
            for part in groups([t or "" for t in batch["text"].to_pylist()], _GROUP):
                for done in encoder.encode(part):
                    ids.append(done + end)
                    keys.append(next(names))
                    held += len(ids[-1]) // size
                    if held >= shard_tokens:
                        yield _shard(seq, ids, keys, encoder.kind, encoder.width)
                        ids, keys, held, seq = [], [], 0, seq + 1
        if ids:
            yield _shard(seq, ids, keys, encoder.kind, encoder.width)

    return run


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Write the documents' ids as shards and return the table of shard files.

    Order is by ``key`` (nulls first), then text. A null text is an empty one and
    holds only the end id; repeated documents are all written; other columns are
    ignored. Without documents there is no shard.
    """
    ordered = texts(docs, key, text).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(_write_batches(tokenizer, shard_tokens, end_id), SHARD_SCHEMA)
    return written(shards, "tokens", maxRecordsPerFile=1, compression="zstd")


def matrix_of(row) -> WaveletMatrix:
    """The wavelet matrix of one shard row."""
    return WaveletMatrix(
        int(row["n_tokens"]),
        [int(z) for z in row["zeros"]],
        [np.frombuffer(p, np.uint8) for p in row["planes"]],
        [np.frombuffer(r, "<u4").astype(np.int64) for r in row["ranks"]],
    )


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            shard = batch.slice(row, 1).to_pylist()[0]
            ids = matrix_of(shard).decode().astype("<u4")
            lengths = np.array(shard["lengths"], np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crcs = [zlib.crc32(ids[a:b].data) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            same = np.ones(len(lengths), np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(same * shard["part"]),
                    pa.array(same * shard["seq"]),
                    pa.array(shard["doc_ids"], pa.int64()),
                    pa.array(starts),
                    pa.array(lengths),
                    pa.array(crcs, pa.int64()),
                ],
                ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )


def read_tokens(shards: DataFrame) -> DataFrame:
    """Per document, from the shard files: ``start`` (ids before it), ``n_tokens``
    and ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers."""
    docs = shards.mapInArrow(
        _read_batches, "part int, seq int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    sizes = shards.select("part", "seq", F.col("n_tokens").alias("ids"))
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("ids"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    parts = parts.select("part", F.coalesce(F.sum("ids").over(upto), F.lit(0)).alias("before_part"))
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", "seq", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    starts = before.join(parts, "part").select("part", "seq", (F.col("before") + F.col("before_part")).alias("first"))
    return docs.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
