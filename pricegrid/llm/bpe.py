"""BPE encoding and decoding with joined trees for long unsplit text.

A text is cut at white space, where no token can cross, and each distinct piece is
encoded once per task. A piece that the tokenizer's pre-tokenizer leaves longer than
a leaf is halved until the halves are leaves; leaves are encoded as one batch,
and encoded halves are joined: a window of tokens on both sides of the join is
encoded anew and grows until its first token equals the left side's and its last
token equals the right side's. From there on both sides are what an encoding of the
whole gives, because byte-pair encodings are determined by their adjacent pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import texts

LEAF = 48  # symbols; a power of two is not needed
CACHE = 300_000  # distinct pieces a task remembers
_BLANKS = "[\t-\r ]+"


class TreeEncoder:
    """Encodes as ``Tokenizer.encode(..., add_special_tokens=False)`` does."""

    def __init__(self, path: str, leaf: int = LEAF, cache: int = CACHE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use all cores
        spec = json.loads(open(path, encoding="utf-8").read())
        spec["truncation"] = spec["padding"] = None
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        inner = json.loads(json.dumps(spec))
        inner["model"]["end_of_word_suffix"] = None
        self.last, self.inner = self.tokenizer, Tokenizer.from_str(json.dumps(inner))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.leaf, self.cache_size = max(1, leaf), cache
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.plain_decoder = spec.get("decoder") is None
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]

    def _tokens(self, piece: str, final: bool) -> list[str]:
        model = (self.last if final else self.inner).model
        return [t.value for t in model.tokenize(piece)]

    def _length(self, token: str, final: bool) -> int:
        return len(token) - (len(self.suffix) if final else 0)

    def _join(self, piece: str, left: list[str], right: list[str], at: int, final: bool) -> list[str]:
        """``left`` encodes ``piece[:at]`` and ``right`` the rest."""
        size = 1
        while True:
            a, b = min(size, len(left)), min(size, len(right))
            ends = final and b == len(right)
            start = at - sum(map(len, left[-a:]))
            end = at + sum(map(len, right[:b])) - (len(self.suffix) if ends else 0)
            window = self._tokens(piece[start:end], ends)
            if (a == len(left) or window[0] == left[-a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[:-a] + window + right[b:]
            size *= 2

    def piece_tokens(self, piece: str) -> list[str]:
        """Tokens of one unsplit piece, by leaves and joins."""
        bounds = list(range(0, len(piece), self.leaf))
        parts = [
            (i, self._tokens(piece[i : i + self.leaf], i + self.leaf >= len(piece))) for i in bounds
        ]
        while len(parts) > 1:
            merged = []
            for k in range(0, len(parts) - 1, 2):
                (start, left), (at, right) = parts[k], parts[k + 1]
                end = parts[k + 2][0] if k + 2 < len(parts) else len(piece)
                joined = self._join(piece[start:end], left, right, at - start, end == len(piece))
                merged.append((start, joined))
            parts = merged + (parts[-1:] if len(parts) % 2 else [])
        return parts[0][1] if parts else []

    def _long(self, chunk: str) -> list[int]:
        normal = self.tokenizer.normalizer
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal.normalize_str(chunk) if normal else chunk)
        find = self.tokenizer.token_to_id
        out: list[int] = []
        for piece, _ in pieces:
            tokens = self.piece_tokens(piece) if len(piece) > self.leaf else self._tokens(piece, True)
            out += [find(t) for t in tokens]
        return out

    def _is_long(self, chunk: str) -> bool:
        return len(chunk) > self.leaf and not any(s in chunk for s in self.special)

    def _entry(self, ids: list[int]) -> tuple[bytes, str]:
        names = self.names
        return np.array(ids, "<u4").tobytes(), " ".join([names[i] for i in ids]) if self.plain_decoder else ""

    def learn(self, chunks: set[str]) -> None:
        """Encode the pieces that are not known yet; a full cache keeps those in use."""
        cache = self.cache
        missing = [c for c in chunks if c not in cache]
        if len(cache) + len(missing) > self.cache_size:
            self.cache = cache = {c: cache[c] for c in chunks if c in cache}
        short = [c for c in missing if len(c) <= self.leaf or not self._is_long(c)]
        done = self.tokenizer.encode_batch_fast(short, add_special_tokens=False)
        for chunk, e in zip(short, done, strict=True):
            cache[chunk] = self._entry(e.ids)
        for chunk in set(missing).difference(short):
            cache[chunk] = self._entry(self._long(chunk))

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Per text its ids as little-endian unsigned 32-bit integers, and the text
        decoded from them. The texts' pieces are numbered, and each is looked up once."""
        split = pc.split_pattern_regex(pa.array(texts, pa.string()), _BLANKS)
        bounds = split.offsets.to_numpy()
        coded = pc.dictionary_encode(split.flatten())
        pieces = coded.dictionary.to_pylist()  # an empty one where a text has blank edges
        self.learn(set(pieces))
        known = [self.cache[c] for c in pieces]
        ids = _strung([k[0] for k in known], coded.indices, bounds)
        if not self.plain_decoder:
            decode = self.tokenizer.decode
            return [(i, decode(np.frombuffer(i, "<u4").tolist(), skip_special_tokens=False)) for i in ids]
        shown = _strung([k[1].encode() + b" " if k[0] else b"" for k in known], coded.indices, bounds)
        return [(i, s[:-1].decode()) for i, s in zip(ids, shown, strict=True)]


def _strung(values: list[bytes], numbers: pa.Array, bounds: np.ndarray) -> list[bytes]:
    """The values of consecutive numbers in one string for each range of numbers."""
    taken = pa.array(values, pa.large_binary()).take(numbers)
    _, ends, data = taken.buffers()
    if not len(taken) or data is None:
        return [b""] * (len(bounds) - 1)
    ends, data = np.frombuffer(ends, np.int64)[bounds].tolist(), data.to_pybytes()
    return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def groups(texts: list[str], size: int = 4_000_000) -> Iterator[list[str]]:
    """Consecutive texts of about ``size`` characters together."""
    part: list[str] = []
    held = 0
    for text in texts:
        if part and held + len(text) > size:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part


@lru_cache(maxsize=2)
def _encoder(path: str, leaf: int) -> TreeEncoder:
    """One encoder for all tasks of a Python worker, so its memory stays warm."""
    return TreeEncoder(path, leaf)


def _encode_batches(path: str, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, leaf)
        for batch in batches:
            done = []
            for part in groups([t or "" for t in batch["text"].to_pylist()]):
                done += encoder.encode(part)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    return run


def _digest_batches(path: str, leaf: int):
    encode = _encode_batches(path, leaf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in encode(batches):
            ids = [i.as_py() for i in batch["ids"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(d.as_py().encode()).hexdigest() for d in batch["decoded"]], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """Per document its ``ids`` (little-endian unsigned 32-bit integers) and the text
    ``decoded`` from them, special tokens kept.

    ``path`` is a tokenizer file whose pre-tokenizer drops white space. A null or
    empty text has no ids and decodes to the empty text. Each row is treated by
    itself, so ties and repeated rows keep their rows; other columns are ignored.
    """
    kind = dict(docs.dtypes)[key]
    return texts(docs, key, text).mapInArrow(
        _encode_batches(path, leaf), f"doc_id {kind}, ids binary, decoded string"
    )


def encoded_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """As ``encoded``, with the number of ids and the digests of ids and text."""
    kind = dict(docs.dtypes)[key]
    return texts(docs, key, text).mapInArrow(
        _digest_batches(path, leaf), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
