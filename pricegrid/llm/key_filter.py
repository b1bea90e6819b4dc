"""A bitmap of keys: a filter of fixed size that lets every wanted row pass.

Rows are only left out when their bit is not set, so what passes is a superset of
what is wanted and an exact join follows. The bitmap has BITS bits whatever the
data: more keys make it less selective, not larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BITS = 1 << 26


def bitmap(df: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """Packed bits of the 64-bit hashes in column ``key``; at most bits / 64 rows
    are collected."""
    slot = f"pmod(`{key}`, {bits})"
    words = (
        df.selectExpr(f"CAST({slot} DIV 64 AS INT) AS w", f"shiftleft(1L, CAST({slot} % 64 AS INT)) AS b")
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out


def passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys % np.int64(len(words) * 64)
    return (words[slot >> 6] >> (slot & 63)) & 1 == 1


def passing(df: DataFrame, key: str, words: np.ndarray) -> DataFrame:
    """The rows of ``df`` whose key may be in the bitmap."""
    shared = df.sparkSession.sparkContext.broadcast(words)  # BITS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(shared.value, batch[key].to_numpy(zero_copy_only=False))))

    return df.mapInArrow(run, df.schema)
