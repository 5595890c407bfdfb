"""Packing of documents into fixed windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, ship
from skyledger.llm.tokens import encoded, tokenizer_path

WINDOW = 2048
#: What is left of a document after its full windows is cut once more, at the last multiple of this: the short tails even
#: out the windows, which leaves under half a percent of padding against four with whole remainders.
TAIL = 256
#: Pieces that are packed together: bounds the memory and time of a task, not the corpus.
BATCH_PIECES = 4096


def differencing(sizes: np.ndarray, ways: int) -> np.ndarray:
    """The window (0 to ways - 1) of each item, sums near equal.

    Each partial partition is a vector of window sums; the two with the widest spread are merged, the largest window of one
    onto the smallest of the other, until one is left. The merges are kept as permutations and unrolled at the end.
    """
    n = len(sizes)
    sums, low = {}, {}
    heap = []
    for i in range(n):
        v = np.zeros(ways, dtype=np.int64)
        v[0] = sizes[i]
        sums[i] = v
        heap.append((-int(sizes[i]), i))
    heapq.heapify(heap)
    merges: list[tuple] = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums.pop(a) + sums.pop(b)[::-1]  # both are kept in descending order
        order = np.argsort(-both, kind="stable").astype(np.int32)
        node = n + len(merges)
        merges.append((a, b, order))
        both = both[order]
        sums[node] = both
        heapq.heappush(heap, (-int(both[0] - both[-1]), node))
    low[heap[0][1]] = np.arange(ways, dtype=np.int32)
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        place = np.empty(ways, dtype=np.int32)  # of the windows before sorting
        place[order] = low.pop(n + k)
        low[a], low[b] = place, place[::-1]
    return np.array([low[i][0] for i in range(n)], dtype=np.int64)


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows for pieces of at most ``capacity``: as few as their sum allows; one more whenever one overflows."""
    ways = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        at = differencing(sizes, ways)
        over = int(np.maximum(np.bincount(at, weights=sizes, minlength=ways) - capacity, 0).max())
        if over <= 0:
            return at
        ways += max(1, int(ways * over) // (2 * capacity))


#: Least sequence_id of a full piece.
FULL = 1 << 62
_PIECES = "part int, seq long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(docs: DataFrame, path: str, capacity: int, tail: int = TAIL) -> DataFrame:
    """Pieces of every document with the checksum of their ids: full windows, a multiple of TAIL, a shorter tail."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded(batch.column("text"), path), strict=True):
                n, view = len(ids) // 4, memoryview(ids)
                ends = sorted({*range(capacity, n, capacity), n // tail * tail, n} - {0})
                for start, end in zip([0, *ends], ends, strict=False):
                    rows.append((part, seq, doc_id, start, end - start, zlib.crc32(view[4 * start : 4 * end]), n))
                    seq += 1
                if len(rows) >= BATCH_PIECES:
                    yield _table(rows)
                    rows = []
        if rows:
            yield _table(rows)

    return docs.select("doc_id", "text").mapInArrow(pieces, _PIECES)


_SCHEMA = pa.schema([("part", pa.int32()), *((n, pa.int64()) for n in ("seq", "doc_id", "start", "length", "ids_crc32", "doc_tokens"))])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def pack_documents(docs: DataFrame, capacity: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every row of ``docs``.

    Documents (null text: empty) are encoded, an end id follows each, and cut (see ``cut``); full pieces are windows by themselves, the rest is packed in batches of about BATCH_PIECES pieces dealt out evenly by hash of where a
    piece was read. Repeated rows and null ids are pieces of their own; an empty table gives an empty result; other columns
    are ignored.
    """
    ship(docs.sparkSession)
    pieces = materialize(cut(docs, tokenizer or tokenizer_path(), capacity), "packing-pieces")
    own = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    # Full pieces need no packing; their numbers lie above those of all batches.
    full = F.lit(FULL) + F.shiftleft(F.col("part").cast("long"), 40) + F.col("seq")
    full = pieces.filter(F.col("length") >= capacity).select(*own, full.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.filter(F.col("length") < capacity)
    batches = max(1, round(short.count() / BATCH_PIECES))
    dealt = short.withColumn("batch", F.pmod(F.xxhash64("part", "seq"), F.lit(batches)))

    def windows(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "part", "seq"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        pdf["sequence_id"] = key[0] * (1 << 32) + pack(pdf["length"].to_numpy(), capacity)
        pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        return pdf[[*own, "sequence_id", "offset"]]

    packed = dealt.groupBy("batch").applyInPandas(windows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return full.unionByName(packed)
