"""Code lengths against Huffman's algorithm and a search over all lengths; the code words and the decoding table of a codebook."""

import heapq
from fractions import Fraction
from functools import cache

import numpy as np
import pytest
from skyledger.llm.token_files import Codebook, code_lengths


def _huffman(counts):
    """Bits of all tokens together by Huffman's algorithm, with no limit."""
    heap, total = list(counts.values()), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def _least(counts, limit):
    """Least bits of all tokens together over all lengths of at most ``limit`` that fit a prefix code."""
    weights = sorted(counts.values(), reverse=True)

    @cache
    def cost(i, room):
        if i == len(weights):
            return 0
        return min((weights[i] * b + cost(i + 1, room - (1 << (limit - b))) for b in range(1, limit + 1) if (1 << (limit - b)) <= room), default=10**12)

    return cost(0, 1 << limit)


def _bits(counts, lengths):
    return sum(n * lengths[t] for t, n in counts.items())


def test_lengths_without_a_limit_that_binds_cost_what_huffman_codes_do():
    rng = np.random.default_rng(1)
    for n in (2, 3, 17, 500):
        counts = {int(t): int(c) for t, c in zip(rng.choice(50_000, n, replace=False), rng.integers(1, 1000, n), strict=True)}
        lengths = code_lengths(counts, 40)
        assert _bits(counts, lengths) == _huffman(counts)
        assert sum(Fraction(1, 1 << b) for b in lengths.values()) == 1


@pytest.mark.parametrize("limit", [3, 4, 6])
def test_limited_lengths_are_the_best_ones(limit):
    rng = np.random.default_rng(limit)
    for _ in range(60):
        counts = {i: int(c) for i, c in enumerate(np.ceil(np.exp(rng.normal(0, 3, rng.integers(2, min(9, 1 << limit))))))}
        lengths = code_lengths(counts, limit)
        assert max(lengths.values()) <= limit and sum(Fraction(1, 1 << b) for b in lengths.values()) == 1
        assert _bits(counts, lengths) == _least(counts, limit)


def test_the_limit_of_16_bits_is_met_where_huffman_codes_are_longer():
    counts, a, b = {}, 1, 1
    for t in range(40):  # counts that grow like this give a code of one token a length
        counts[t], a, b = a, b, a + b
    lengths = code_lengths(counts)
    assert max(lengths.values()) == 16 and sum(Fraction(1, 1 << n) for n in lengths.values()) == 1
    assert _huffman(counts) < _bits(counts, lengths)
    assert max(code_lengths(counts, 60).values()) == 39


def test_one_token_and_none():
    assert code_lengths({7: 5}) == {7: 1} and code_lengths({}) == {}


def test_code_words_are_canonical_and_tell_all_tokens():
    rng = np.random.default_rng(3)
    lengths = code_lengths({int(t): int(c) for t, c in zip(rng.choice(5000, 300, replace=False), rng.integers(1, 10_000, 300), strict=True)})
    book, last = Codebook(lengths), -1
    for t in sorted(lengths, key=lambda t: (lengths[t], t)):
        word = int(book.words[t]) << (book.width - lengths[t])
        assert word > last  # in the order of length and token, and no word begins another
        last = word + (1 << (book.width - lengths[t])) - 1
        assert set(book.symbols[word : last + 1].tolist()) == {t} and set(book.steps[word : last + 1].tolist()) == {lengths[t]}
    assert last == (1 << book.width) - 1
