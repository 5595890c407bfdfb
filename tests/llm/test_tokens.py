"""The encoder with its memory of chunks against the whole tokenizer."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skyledger.llm import tokens

ODD = "aB cÉß'stSd0١ \n\t\x0b\x1c\x85\xa0.,!-«»²½ⅧéÀÿŒ中文😀İı́​  _"


@pytest.mark.parametrize("remembered", [tokens.CACHE_CHUNKS, 3])
def test_odd_strings(monkeypatch, remembered):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", remembered)
    path = tokens.tokenizer_path()
    whole, enc, rng = Tokenizer.from_file(path), tokens.Encoder(path), random.Random(remembered)
    for _ in range(15_000 if remembered > 3 else 2_000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) + rng.choice(["", "", "", "<|endoftext|>", "<|startoftext|>x", "<|endoftext|>.", "don't", "I'LL"])
        expected = np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert enc(text.encode()) == expected, repr(text)


def test_end_id_follows_each_text():
    path = tokens.tokenizer_path()
    got = [np.frombuffer(x, "<u4").tolist() for x in tokens.encoded(pa.array(["a b", None, ""]), path)]
    assert got == [[*Tokenizer.from_file(path).encode("a b", add_special_tokens=False).ids, 1], [1], [1]]
