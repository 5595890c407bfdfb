"""Retrieval against brute-force BM25 over all windows, odd rows, shards."""

import math
from collections import Counter

import numpy as np
import pytest
from skyledger.llm import decontaminate as d

SF = "/root/testdata/sf0.001"


def _scores(passages, query):
    """BM25 of each passage against the distinct words of a query, as a share of its own score."""
    df = Counter(t for w in passages for t in set(w))
    mean = sum(map(len, passages)) / len(passages)
    out = []
    for w in passages:
        n = Counter(w)
        x = {t: math.log(1 + (len(passages) - df[t] + 0.5) / (df[t] + 0.5)) * c * (d.K1 + 1) / (c + d.K1 * (1 - d.B + d.B * len(w) / mean)) for t, c in n.items()}
        out.append(sum(x[t] for t in x if t in query) / sum(x.values()))
    return out


@pytest.mark.parametrize(("rest", "block"), [(0.5, 16), (0.2, 2), (0.9, 1)])
def test_wand_retrieves_all_above_threshold(monkeypatch, rest, block):
    monkeypatch.setattr(d, "REST", rest)
    monkeypatch.setattr(d, "BLOCK", block)
    rng = np.random.default_rng(block)
    words = [f"w{i}" for i in range(120)]
    weights = 1 / np.arange(1, 121)
    draw = lambda n: rng.choice(words, n, p=weights / weights.sum()).tolist()
    passages = [draw(int(n)) for n in rng.integers(1, 40, 150)]
    index = d.Index(list(enumerate(passages)))
    hits = 0
    for _ in range(150):
        text = [*draw(int(rng.integers(0, 150))), *passages[rng.integers(150)], *draw(int(rng.integers(0, 400)))]
        (chunks, codes), = index.chunks.runs(" ".join(text))
        live = {q for _, q in index.queries([codes])}
        for q in range(max(1, -(-len(text) // d.STEP) - 1)):
            query = set(text[q * d.STEP : (q + 2) * d.STEP])
            expected = {p for p, s in enumerate(_scores(passages, query)) if s >= index.need[p] - 1e-9}
            hits += len(expected)
            if q in live:
                assert set(index.retrieve([index.terms[w] for w in query if w in index.terms])) == expected
            else:
                assert not expected
    assert hits > 100


def test_search_does_not_depend_on_how_texts_are_cut(monkeypatch):
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    items = [word(int(n)) for n in rng.integers(10, 90, 30)]
    index = d.Index(list(enumerate(items)))
    texts = [" - ".join([" ".join(word(300)), ", ".join(items[i]), "well-known x-" + "-".join(items[(i + 1) % 30]), " ".join(word(50))]) for i in range(30)]
    expected = [{i, (i + 1) % 30} for i in range(30)]
    for size in (1 << 20, 900):
        monkeypatch.setattr(d, "SLICE", size)
        monkeypatch.setattr(d, "TOGETHER", size)
        assert [set(x) for x in index.search(texts)] == expected


@pytest.mark.parametrize("size", [20_000, 7])
def test_leaks_odd_rows_and_shards(spark, monkeypatch, size):
    monkeypatch.setattr(d, "SHARD_PASSAGES", size)
    rng = np.random.default_rng(6)
    items = [" ".join(f"a{x}" for x in rng.integers(0, 10**6, 20)) for _ in range(30)]
    rows = [(i, x) for i, x in enumerate(items)] + [(100, items[0]), (101, None), (102, ""), (103, " .,- ")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs = [(None, items[1]), (1, None), (2, ""), (3, items[0]), (3, items[0]), (4, "b " * 30000 + items[2]), (5, items[3].upper()), (6, items[4][: len(items[4]) // 2])]
    df = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, overlap int")
    got = sorted(((r.doc_id, r.item_id) for r in d.find_leaks(df, bench).collect()), key=str)
    assert got == sorted([(None, 1), (3, 0), (3, 100), (4, 2), (5, 3)], key=str)
    assert d.find_leaks(df.limit(0), bench).count() == 0
    assert d.find_leaks(df, bench.limit(0)).count() == 0


def test_most_leaks_with_one_word_in_seven_changed_are_held():
    """Edits fall anywhere, so one half may have most of them; words in another order, halves and prose of the same words are no leak."""
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(600)]
    draw = lambda n: rng.choice(vocabulary, n).tolist()
    items = [draw(int(n)) for n in rng.integers(15, 60, 60)]
    index = d.Index(list(enumerate(items)))
    for share, least in ((0.05, 0.99), (0.1, 0.97), (0.15, 0.9)):
        texts = [" ".join([*draw(int(rng.integers(0, 250))), *(draw(1)[0] if rng.random() < share else w for w in x), *draw(40)]) for x in items * 3]
        found = index.search(texts)
        assert sum(k % 60 in x for k, x in enumerate(found)) >= least * len(found)
        assert all(set(x) <= {k % 60} for k, x in enumerate(found))
    others = [*(rng.permutation(x).tolist() for x in items), *(x[: len(x) // 2] + draw(60) for x in items), *(draw(2000) for _ in range(40))]
    assert not any(index.search([" ".join(x) for x in others]))


def test_edits_are_counted_over_the_item():
    words = [f"w{i}" for i in range(40)]
    index = d.Index([(0, words), (1, [f"v{i}" for i in range(40)])])
    edited = lambda at: " ".join("x" if i in at else w for i, w in enumerate(words))
    first = [*range(0, 20, 2)]
    assert index.search([edited(first[:8]), edited([*first[:8], 25, 35]), edited(first[:9]), edited([*first[:8], 22, 25, 35])]) == [{0: pytest.approx(0.6)}, {0: pytest.approx(0.6)}, {}, {}]


def test_short_items_are_held_by_whole_texts_alone(spark):
    bench = spark.createDataFrame([(0, "Yes."), (1, "yes no"), (2, "a b c d e f g"), (3, "m n o p q r s t"), (4, "A, b c d e f g")], "item_id long, text string")
    docs = [(0, "yes"), (1, "well, yes no"), (2, " YES -- no!"), (3, "a b c d e f g"), (4, "m n o p q r s t"), (5, "x m n o p q r s t y"), (9, "a b c d e f g h"), (6, "no yes"), (7, None), (8, "")]
    got = sorted(map(tuple, d.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()))
    assert got == [(0, 0, 1.0), (2, 1, 1.0), (3, 2, 1.0), (3, 4, 1.0), (4, 3, 1.0), (5, 3, 1.0)]
    assert d.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench.filter("item_id < 2")).count() == 2
