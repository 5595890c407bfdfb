"""Token ids by a public tokenizer, with word-level reuse.

The tokenizer drops white space and never joins pieces across it, so the ids of a text are those of its blank-separated
chunks in order. Each distinct chunk is encoded once: in the Latin letters and signs below it is cut here as the tokenizer's
own rules cut it, and its pieces are given to the BPE model; any other chunk goes through the whole tokenizer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

END_ID = 1
WORD_TOKENIZER = "word_bpe_49k.json"
#: Distinct chunks that a worker remembers; beyond it starts afresh, so memory has a bound.
CACHE_CHUNKS = 600_000

_LATIN = "a-zß-öø-ÿ"
_SAFE = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]*")
#: Fixed value: the pre-tokenizer's pattern, in these letters.
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^\x20\x09-\x0D0-9{_LATIN}]+")


def tokenizer_path(name: str = WORD_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The letters of byte-level BPE: printable bytes stand for themselves, the others for the letters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class _Chunks(dict):
    """Ids of each chunk of a text (no white space in it), as bytes; those that are not there yet are found on look-up."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _piece(self, piece: bytes) -> bytes:
        """Of a piece as the tokenizer's rules cut it, in lower case."""
        mapped = piece.decode() if piece.isascii() else "".join([self.letters[b] for b in piece])
        return b"".join([self.words[t.id] for t in self.model.tokenize(mapped)])

    def __missing__(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # Latin letters without accents
            low = chunk.lower()
            ids = self._piece(chunk) if low == chunk else self[low]
        elif chunk[-1:] in (b".", b",") and chunk[:-1].isalpha():
            ids = self[chunk[:-1]] + self[chunk[-1:]]
        else:
            text = chunk.decode("utf-8", "replace")
            if _SAFE.fullmatch(text) and "<|" not in text:
                pieces = [p.encode() for p in _PIECE.findall(text.lower())]
                ids = self._piece(chunk) if pieces == [chunk] else b"".join([self[p] for p in pieces])
            else:
                ids = b"".join([self.words[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])
        self[chunk] = ids
        return ids


class Encoder:
    """Little-endian unsigned 32-bit ids of texts, as bytes."""

    def __init__(self, path: str) -> None:
        self.chunks = _Chunks(path)

    def __call__(self, text: bytes) -> bytes:
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks.clear()
        # Of bytes, split() takes exactly the white space [\x20\x09-\x0D].
        return b"".join(map(self.chunks.__getitem__, text.split()))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker and file: what it has learnt serves later tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_END = END_ID.to_bytes(4, "little")


def encoded(column: pa.Array, path: str) -> Iterator[bytes]:
    """Of each text (null: empty) its ids and the end id, four bytes each."""
    enc = encoder(path)
    for t in column.cast(pa.binary()):
        yield enc(t.as_buffer().to_pybytes()) + _END if t.is_valid else _END
