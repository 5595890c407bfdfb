"""Token files: ids in canonical length-limited Huffman code, in blocks that decode alone, with bit-offset checkpoints.

A token file set is two Parquet tables: ``codebook`` (token, bits) and ``blocks``. A block holds whole documents in
ascending order; its ``payload`` is one bit string, ``checkpoints`` has the bit offset of every SEGMENT-th id, so segments
decode side by side by table lookup. Code words follow from the lengths alone (canonical: by length, then token).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, ship
from skyledger.llm.tokens import encoded, tokenizer_path

MAX_BITS = 16
SEGMENT = 256
#: A block ends with the document that reaches so many ids.
BLOCK_IDS = 1 << 18


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``max_bits`` bits, by package-merge. The table has one entry a vocabulary token at most."""
    tokens = sorted(counts, key=lambda t: (counts[t], t))
    if len(tokens) <= 1:
        return dict.fromkeys(tokens, 1)
    max_bits = max(max_bits, (len(tokens) - 1).bit_length())
    weights = np.array([counts[t] for t in tokens], dtype=np.float64)
    n, merged, rounds = len(tokens), weights, []
    for _ in range(max_bits - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        rounds.append(order < n)
        merged = both[order]
    # From the last round back: a chosen package stands for two items of the round before; single tokens get one bit more.
    bits, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for single in reversed(rounds):
        chosen = int(single[:take].sum())
        bits[:chosen] += 1
        take = 2 * (take - chosen)
    bits[:take] += 1
    return {t: int(b) for t, b in zip(tokens, bits, strict=True)}


class Codebook:
    """Code words and the decoding table of canonical codes."""

    def __init__(self, lengths: dict[int, int]) -> None:
        order = sorted(lengths, key=lambda t: (lengths[t], t))
        self.width = max(lengths.values(), default=1)
        self.bits = np.zeros(max(lengths, default=0) + 1, dtype=np.uint8)
        self.words = np.zeros(len(self.bits), dtype=np.uint64)
        self.symbols = np.zeros(1 << self.width, dtype=np.uint32)
        self.steps = np.ones(1 << self.width, dtype=np.uint8)
        at = 0
        for t in order:
            b = lengths[t]
            self.bits[t], self.words[t] = b, at >> (self.width - b)
            end = at + (1 << (self.width - b))
            self.symbols[at:end], self.steps[at:end] = t, b
            at = end

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bit string, and the bit offset of every SEGMENT-th id."""
        bits = self.bits[ids].astype(np.int64)
        ends = np.cumsum(bits)
        starts = ends - bits
        # Each word is put into the 64 bits that begin at its 32-bit cell, then split over that cell and the next.
        shifted = self.words[ids] << (64 - bits - (starts & 31)).astype(np.uint64)
        cells, n = starts >> 5, int(ends[-1] // 32 + 2) if len(ids) else 2
        # Bits of different ids never overlap: sums below 2**32 are exact in doubles.
        out = np.bincount(cells, (shifted >> np.uint64(32)).astype(np.float64), n) + np.bincount(cells + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
        return out.astype(np.uint32).astype(">u4").tobytes(), starts[::SEGMENT]

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All segments of a block step by step side by side."""
        cells = np.frombuffer(payload, dtype=">u4").astype(np.uint64)
        # The last segment may end early, and then reads on in zeros.
        pairs = np.concatenate([(cells[:-1] << np.uint64(32)) | cells[1:], np.zeros(SEGMENT * self.width // 32 + 1, np.uint64)])
        at = np.asarray(checkpoints, dtype=np.uint64).copy()
        out = np.zeros((SEGMENT, len(at)), dtype=np.uint32)
        five, low, top, mask = np.uint64(5), np.uint64(31), np.uint64(64 - self.width), np.uint64((1 << self.width) - 1)
        both = self.symbols.astype(np.uint64) << np.uint64(8) | self.steps
        for i in range(SEGMENT):
            window = pairs[at >> five] >> (top - (at & low)) & mask
            found = both[window]
            out[i] = found >> np.uint64(8)
            at += found & np.uint64(255)
        return out.T.reshape(-1)[:n]


_RAW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary()), ("tokens", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_RAW_DDL = "part int, block int, doc_ids array<long>, lengths array<long>, payload binary, tokens array<long>, counts array<long>"


def _row(schema: pa.Schema, *values: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def raw_blocks(ordered: DataFrame, path: str) -> DataFrame:
    """Plain ids in blocks of whole documents, from rows in their final order within and across partitions. A partition's last
    row has no payload: it says how often each id occurs in the blocks before."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, size = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        total = np.zeros(0, dtype=np.int64)

        def row() -> pa.RecordBatch:
            nonlocal total
            payload = b"".join([x for _, x in held])
            new = np.bincount(np.frombuffer(payload, dtype="<u4"), minlength=len(total))
            new[: len(total)] += total
            total = new
            return _row(_RAW, part, block, [d for d, _ in held], [len(x) // 4 for _, x in held], payload, None, None)

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded(batch.column("text"), path), strict=True):
                held.append((doc_id, ids))
                size += len(ids) // 4
                if size >= BLOCK_IDS:
                    yield row()
                    held, size, block = [], 0, block + 1
        if held:
            yield row()
        tokens = np.flatnonzero(total)
        if len(tokens):
            yield _row(_RAW, part, None, None, None, None, tokens, total[tokens])

    return ordered.select("doc_id", "text").mapInArrow(encode, _RAW_DDL)


def token_counts(raw: DataFrame) -> dict[int, int]:
    """How often each id occurs over all blocks; one entry a vocabulary token at most reaches the driver."""
    each = raw.select(F.explode(F.arrays_zip("tokens", "counts")).alias("of")).groupBy(F.col("of.tokens").alias("token"))
    return {r["token"]: r["n"] for r in each.agg(F.sum("of.counts").alias("n")).collect()}


def write_token_files(docs: DataFrame, out: str, tokenizer: str | None = None, partitions: int | None = None) -> None:
    """Encode every text of ``docs`` (doc_id, text; null text: empty) in ascending doc_id order into ``out``.

    An end id follows each document. Null ids come first; rows with equal ids are in order of their text's hash. The rows
    are range-partitioned by id and hash, so neither many equal ids nor long texts land in one task; a block ends after the
    document that fills it, so the ids of one text must fit one value (2 GB, about 500 million ids; a longer text is an error). An
    empty table gives an empty file set. Other columns are ignored.
    """
    ship(docs.sparkSession)
    spark, path = docs.sparkSession, tokenizer or tokenizer_path()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    ordered = keyed.repartitionByRange(n, "doc_id", "_hash").sortWithinPartitions("doc_id", "_hash")
    raw = materialize(raw_blocks(ordered, path), "token-files-raw")
    lengths = code_lengths(token_counts(raw))
    spark.createDataFrame(list(lengths.items()), "token long, bits int").coalesce(1).write.parquet(f"{out}/codebook")
    shared = spark.sparkContext.broadcast(lengths)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(shared.value)
        for b in batches:
            for i, payload in enumerate(b.column("payload")):
                bits, marks = book.encode(np.frombuffer(payload.as_buffer(), dtype="<u4"))
                yield pa.RecordBatch.from_pydict({n: b.column(n).slice(i, 1) for n in ("part", "block", "doc_ids", "lengths")} | {"checkpoints": pa.array([marks], pa.list_(pa.int64())), "payload": pa.array([bits], pa.binary())})

    blocks = raw.filter("payload is not null").drop("tokens", "counts").mapInArrow(compress, "part int, block int, doc_ids array<long>, lengths array<long>, checkpoints array<long>, payload binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{out}/blocks")


def _decoded(blocks: DataFrame, book: dict[int, int], with_ids: bool) -> DataFrame:
    shared = blocks.sparkSession.sparkContext.broadcast(book)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(shared.value)
        for b in batches:
            for r in b.to_pylist():
                ids = book.decode(r["payload"], np.array(r["checkpoints"]), sum(r["lengths"])).astype("<u4")
                ends = np.cumsum(r["lengths"])
                parts = [ids[e - k : e] for e, k in zip(ends, r["lengths"], strict=True)]
                out = {
                    "part": pa.array([r["part"]] * len(ends), pa.int32()), "block": pa.array([r["block"]] * len(ends), pa.int32()), "doc_id": pa.array(r["doc_ids"], pa.int64()),
                    "before": pa.array(ends - r["lengths"], pa.int64()), "n_tokens": pa.array(r["lengths"], pa.int64()), "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(parts, pa.list_(pa.int64()))} if with_ids else {}))

    return blocks.mapInArrow(decode, "part int, block int, doc_id long, before long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def read_token_files(spark: SparkSession, source: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids of every document in the files."""
    ship(spark)
    book = {r["token"]: r["bits"] for r in spark.read.parquet(f"{source}/codebook").collect()}
    blocks = spark.read.parquet(f"{source}/blocks")
    sizes = blocks.select("part", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before(Window.orderBy("part")).alias("_part_start"))
    starts = sizes.select("part", "block", before(Window.partitionBy("part").orderBy("block")).alias("_in_part"))
    out = _decoded(blocks, book, with_ids).join(starts, ["part", "block"]).join(F.broadcast(parts), "part")
    return out.select("doc_id", (F.col("before") + F.col("_in_part") + F.col("_part_start")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
