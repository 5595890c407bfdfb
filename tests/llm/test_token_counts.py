"""Token files: counts that come with the blocks, and blocks whose last segment ends early."""

import numpy as np
import pytest

from skyledger.llm import token_files, tokens


def test_counts_come_with_the_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i % 7} and {'more ' * (i % 40)}" if i % 9 else None) for i in range(300)], "doc_id long, text string").repartition(3)
    raw = token_files.raw_blocks(docs, tokens.tokenizer_path()).cache()
    assert raw.filter("tokens is not null").count() == 3 and raw.filter("payload is null and tokens is null").count() == 0
    ids = np.concatenate([np.frombuffer(r.payload, "<u4") for r in raw.filter("payload is not null").collect()])
    assert token_files.token_counts(raw) == {int(t): int(n) for t, n in zip(*np.unique(ids, return_counts=True), strict=True)}
    raw.unpersist()


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_blocks_of_any_length(n):
    rng = np.random.default_rng(n)
    book = token_files.Codebook(token_files.code_lengths({int(t): int(c) for t, c in zip(range(400), rng.integers(1, 10**6, 400) ** 2, strict=True)}))
    ids = rng.integers(0, 400, n)
    payload, marks = book.encode(ids)
    assert book.decode(payload, marks, n).tolist() == ids.tolist()
