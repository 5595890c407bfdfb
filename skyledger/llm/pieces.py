"""SentencePiece encoding with the byte span of every piece, and decoding.

Texts are normalised here: at each place the longest key of the model's compiled character map (a double-array trie and a
blob of replacements) is taken, and every byte that comes out remembers where its source began. The pieces of what comes
out, found by the library with its own normaliser off, are led back over that alignment to bytes of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import named, ship

PIECE_MODEL = "piece_bpe_32k.model"
#: The sign that stands for a space in pieces.
SPACE = "▁".encode()
#: Ids that a task gathers before it hands rows on.
EMIT_IDS = 1 << 18


class CharMap:
    """A compiled character map: four bytes with the size of the trie, the trie's units, replacements that end with a zero."""

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).astype(np.int64)
        self.blob = np.frombuffer(compiled, np.uint8, offset=4 + size)
        self.zeros = np.flatnonzero(self.blob == 0)

    @staticmethod
    def _offset(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of the longest key at each of ``starts`` (0: none) and where its replacement lies; all places go down the trie side by side."""
        length, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        live, at, depth = np.arange(len(starts)), np.full(len(starts), self._offset(self.units[0])), 0
        while True:
            inside = starts[live] + depth < len(raw)
            live, at = live[inside], at[inside]
            if not len(live):
                return length, value
            byte = raw[starts[live] + depth].astype(np.int64)
            at = at ^ byte
            unit = self.units[at]
            known = (unit & 0x800000FF) == byte
            live, at, unit = live[known], at[known] ^ self._offset(unit[known]), unit[known]
            ends, depth = (unit >> 8) & 1 == 1, depth + 1
            length[live[ends]], value[live[ends]] = depth, self.units[at[ends]] & 0x7FFFFFFF

    def sizes(self, value: np.ndarray) -> np.ndarray:
        return self.zeros[np.searchsorted(self.zeros, value)] - value


class Normalizer:
    """Normalised bytes of a text and, for each of them and the end, the byte of the text where its source begins.

    ``spec`` is the normaliser part of a model. Bytes that are no UTF-8 must have been replaced before.
    """

    def __init__(self, spec, suffix: bool = False) -> None:
        self.chars = CharMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.dummy, self.squeeze, self.escape, self.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces, suffix

    def _pieces(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Source start of each unit, pool of bytes, where in it the unit's output lies, how long that is."""
        starts = np.flatnonzero((raw & 0xC0) != 0x80)
        sizes = np.diff(starts, append=len(raw))
        if self.chars is None:
            return starts, raw, starts, sizes
        length, value = self.chars.longest(raw, starts)
        follows = np.searchsorted(starts, starts + np.where(length > 0, length, sizes))
        used, i = np.ones(len(starts), bool), 0
        for i in np.flatnonzero(follows > np.arange(len(starts)) + 1):  # keys of several characters
            if used[i]:
                used[i + 1 : follows[i]] = False
        starts, sizes, length, value = starts[used], sizes[used], length[used], value[used]
        hit = length > 0
        at, out = starts.copy(), sizes.copy()
        at[hit], out[hit] = len(raw) + value[hit], self.chars.sizes(value[hit])
        return starts, np.concatenate([raw, self.chars.blob]), at, out

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        raw = np.frombuffer(text, np.uint8)
        if not len(raw):
            return b"", np.zeros(1, np.int64)
        starts, pool, at, out = self._pieces(raw)
        begin, end = 0, len(raw)
        if self.squeeze:
            blank = (out == 1) & (pool[np.minimum(at, len(pool) - 1)] == 32)
            if blank.all():
                return b"", np.zeros(1, np.int64)
            begin = int(starts[np.argmin(blank)])
            at, out = self._squeezed(pool, at, out)
        ends = np.cumsum(out)
        norm = pool[np.repeat(at - (ends - out), out) + np.arange(ends[-1])]
        align = np.repeat(starts, out)
        if self.dummy:
            norm, align = (np.append(norm, 32), np.append(align, end)) if self.suffix else (np.insert(norm, 0, 32), np.insert(align, 0, begin))
        sign = SPACE if self.escape else b" "
        if self.escape:
            blank = norm == 32
            times = np.where(blank, len(SPACE), 1)
            norm, align, blank = np.repeat(norm, times), np.repeat(align, times), np.repeat(blank, times)
            norm[blank] = np.tile(np.frombuffer(SPACE, np.uint8), int(blank.sum()) // len(SPACE))
        out = norm.astype(np.uint8).tobytes()
        if self.squeeze and not self.suffix:  # signs that the text itself holds go too
            n = len(out)
            while out.endswith(sign, 0, n):
                n -= len(sign)
            end = int(align[n]) if n < len(out) else end
            out, align = out[:n], align[:n]
        return out, np.append(align, end)

    @staticmethod
    def _squeezed(pool: np.ndarray, at: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units without leading spaces where the last one that has bytes ended with a space, or none came before."""
        held = np.flatnonzero(out > 0)
        at, out = at.copy(), out.copy()
        ends_blank = pool[at[held] + out[held] - 1] == 32
        trimmed = held[np.insert(ends_blank, 0, True)[:-1]]
        while len(trimmed := trimmed[out[trimmed] > 0]) and len(trimmed := trimmed[pool[at[trimmed]] == 32]):
            at[trimmed] += 1
            out[trimmed] -= 1
        return at, out


class Encoder:
    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if any(p.type == 4 for p in proto.pieces):
            raise ValueError("models with pieces of the user's own are not supported")
        self.model = model
        self.normalizer = Normalizer(proto.normalizer_spec, proto.trainer_spec.treat_whitespace_as_suffix)
        # A piece for a byte stands for one; others for their own bytes.
        self.sizes = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces])
        spec = proto.normalizer_spec
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = b"", False, False, False
        self.normalized = proto.SerializeToString()

    @cached_property
    def whole(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def bare(self):
        """The library with its normaliser off."""
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.normalized)

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces, and the bytes of ``text`` where each begins and ends; the end id stands behind the text."""
        norm, align = self.normalizer(text)
        ids = np.array(self.bare.encode(norm), np.int32)
        sizes = self.sizes[ids]
        unknown = ids == self.bare.unk_id()
        if unknown.any():
            sizes[unknown] = [len(p.encode()) for p, u in zip(self.bare.encode(norm, out_type=str), unknown, strict=True) if u]
        ends = np.cumsum(sizes)
        if len(ends) and ends[-1] != len(norm):
            raise ValueError("pieces do not add up to the text")
        return np.append(ids, self.bare.eos_id()), np.append(align[ends - sizes], len(text)), np.append(align[ends], len(text))


@lru_cache(maxsize=4)
def encoder(model: bytes) -> Encoder:
    """One for each worker and model."""
    return Encoder(model)


def model_path(name: str = PIECE_MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(path: str | None) -> bytes:
    with open(path or model_path(), "rb") as f:
        return f.read()


def encode_pieces(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids (with an end id), begins, ends of every text of ``docs``: piece i is bytes begins[i] to ends[i] of its UTF-8.

    Ids are those of the sentencepiece library, no sampling. Of a character that falls into byte pieces the last has its
    bytes, the others are empty, and so is the dummy prefix; null text is empty: the end id alone. Rows of equal or null ids
    are documents of their own; an empty table gives an empty one; other columns are ignored. The model is read on the
    driver and sent to the workers; models with user-defined pieces are refused.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_read(model))  # one model

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for b in batches:
            texts, at, held, n = b.column("text").cast(pa.binary()), 0, [], 0
            for i, t in enumerate(texts):
                text = t.as_buffer().to_pybytes() if t.is_valid else b""
                held.append(enc(text.decode("utf-8", "replace").encode()))
                n += len(held[-1][0])
                if n >= EMIT_IDS or i + 1 == len(texts):
                    yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").slice(at, len(held))} | {c: _lists([h[k] for h in held]) for k, c in enumerate(("ids", "begins", "ends"))})
                    at, held, n = i + 1, [], 0

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>, begins array<int>, ends array<int>")


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(values).astype(np.int32))


def decode_pieces(pieces: DataFrame, model: str | None = None) -> DataFrame:
    """``pieces`` with column text: its ids decoded by the library. A null array gives a null text."""
    ship(pieces.sparkSession)
    shared = pieces.sparkSession.sparkContext.broadcast(_read(model))  # one model
    own = [c for c in pieces.columns if c != "text"]

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        enc = encoder(shared.value)
        return pa.array([enc.whole.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in ids], pa.string())

    return pieces.select(*map(named, own), decode("ids").alias("text"))
