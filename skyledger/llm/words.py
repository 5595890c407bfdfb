"""Words of texts as 64-bit hashes, for operators that compare word sequences in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import BLANKS, LOWER, UPPER

#: Words that are hashed at once.
CHUNK = 500_000

_MULT = np.uint64(0x9E3779B97F4A7C15)


def step(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hash ``x`` of some words taken one word further."""
    return (x ^ (x >> np.uint64(31))) * _MULT + h


def end(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MULT
    return x ^ (x >> np.uint64(29))


def folded(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position, still open for more."""
    x = np.zeros(len(at), np.uint64)
    for j in range(n):
        x = step(x, h[at + j])
    return x


def with_words(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and _h: hashes of the blank-separated words of column text, A-Z lower-cased; null text: none."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), BLANKS + UPPER, " " * len(BLANKS) + LOWER)
    split = docs.select(*keep, F.array_remove(F.split(text, " "), "").alias("_w"))
    return split.select(*keep, F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, ends of the rows (from 0) and hashes of all words of runs of rows of about CHUNK words."""
    col = batch.column("_h")
    flat, ends = col.values.to_numpy(zero_copy_only=False).view(np.uint64), col.offsets.to_numpy().astype(np.int64)
    a = 0
    while a < len(ends) - 1:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + CHUNK, "right")) - 1)
        yield a, ends[a : b + 1] - ends[a], flat[ends[a] : ends[b]]
        a = b
