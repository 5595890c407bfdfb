"""Large groups of near copies, of which any two may or may not link: what is compared grows with the group, not with its square."""

import numpy as np
import pytest

from skyledger.llm import ngram_join


def _copies(n: int, edits: float, words: int = 120) -> list[tuple[int, str]]:
    rng = np.random.default_rng(n)
    base = [f"w{x}" for x in rng.integers(0, 10**6, words)]
    return [(i, " ".join(f"x{i}y{j}" if rng.random() < edits / words else w for j, w in enumerate(base))) for i in range(n)]


def _components(docs: list[tuple[int, str]], n: int, percent: int) -> dict[int, int]:
    """By comparison of all pairs, as products of bit vectors."""
    sets = [{tuple(w[p : p + n]) for p in range(len(w) - n + 1)} for w in (t.split() for _, t in docs)]
    grams = {g: i for i, g in enumerate(set().union(*sets))}
    held = np.zeros((len(sets), len(grams)), np.float32)
    for i, s in enumerate(sets):
        held[i, [grams[g] for g in s]] = 1
    both, size = held @ held.T, held.sum(1)
    links = 100 * both >= percent * (size[:, None] + size - both)
    label = np.arange(len(sets))
    while ((new := np.where(links, label, len(sets)).min(1)) < label).any():
        label = new
    return dict(enumerate(label.tolist()))


@pytest.mark.parametrize("edits", [2.0, 3.5])
def test_comparisons_grow_with_the_group(spark, monkeypatch, edits):
    compared, linked = [], ngram_join.linked
    monkeypatch.setattr(ngram_join, "linked", lambda pairs, *a: compared.append(pairs.count()) or linked(pairs, *a))
    docs = _copies(600, edits)
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), 3, 90).collect()}
    assert got == _components(docs, 3, 90)
    assert sum(compared) < 20 * len(docs), compared
