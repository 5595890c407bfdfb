"""Connected components: any graph, in few passes, and nothing but the result stays on disk."""

import os
import random

import pytest

from skyledger.llm import common, components as cc

PATH = [(i, i + 1) for i in range(300)]
STAR = [(0, i) for i in range(1, 300)]
TWO = [(i, i + 2) for i in range(100)] + [(7, 7), (1000, 1001)]
RANDOM = [(random.Random(1).randrange(400) + i % 7, random.Random(i).randrange(400)) for i in range(250)]


def _brute(edges: list[tuple[int, int]]) -> set[frozenset[int]]:
    of: dict[int, set[int]] = {}
    for a, b in edges:
        both = of.setdefault(a, {a}) | of.setdefault(b, {b})
        of.update(dict.fromkeys(both, both))
    return set(map(frozenset, of.values()))


@pytest.mark.parametrize(("edges", "most"), [(STAR, 5), (PATH, 40), (TWO, 40), (RANDOM, 40), ([], 2)])
def test_groups_passes_and_what_stays(spark, monkeypatch, edges, most):
    written, shared = [], common.shared_dir(spark).removeprefix("file://")
    monkeypatch.setattr(cc, "materialize", lambda df, name: written.append(name) or common.materialize(df, name))
    before = set(os.listdir(shared))
    got: dict[int, set[int]] = {}
    for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect():
        got.setdefault(r.label, set()).add(r.node)
    assert set(map(frozenset, got.values())) == _brute(edges)
    assert all(label in nodes for label, nodes in got.items())
    assert len(written) <= most
    assert len(set(os.listdir(shared)) - before) == 1
