"""The shard capacity against the least one over the groups in their order, by brute force."""

import numpy as np
import pytest

from skyledger.llm import sharding


def _least(sizes, shards):
    """Smallest largest sum of contiguous parts, by dynamic programming."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    best = sums.astype(float)
    for _ in range(shards - 1):
        best = np.array([0.0] + [min(max(best[j], sums[i] - sums[j]) for j in range(i)) for i in range(1, len(sums))])
    return int(best[-1])


@pytest.mark.parametrize("per_shard", [1, 3])
def test_runs_lead_to_the_least_capacity(per_shard):
    rng = np.random.default_rng(per_shard)
    for _ in range(200):
        sizes = rng.integers(1, 60, rng.integers(1, 60)).tolist()
        shards = int(rng.integers(1, 9))
        starts, total = [0, *np.cumsum(sizes)[:-1].tolist()], sum(sizes)

        def read(width, stretches, starts=starts):
            out = {}
            for key, s in enumerate(starts):
                if any(a <= s < b for a, b in stretches):
                    out.setdefault((next(i for i, (a, b) in enumerate(stretches) if a <= s < b), s // width), []).append((s, key))
            return [(*min(g), len(g)) for g in out.values()]

        width = max(1, -(-total // (shards * per_shard)))
        runs = sharding.Runs(read(width, [(0, total)]), total)
        while (low := runs.least(shards, True)) < (high := runs.least(shards, False)):
            stretches = runs.open(low, high, shards)
            assert stretches
            gone = {a for a, _ in stretches}
            width = max(1, min(sum(b - a for a, b in stretches) // (shards * per_shard), width // 2))
            runs = sharding.Runs([r for r in runs.rows if r[0] not in gone] + read(width, stretches), total)
        assert high == _least(sizes, shards)


def test_plan_on_a_table(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUNS_PER_SHARD", 4)
    rng = np.random.default_rng(9)
    rows = [(int(k), int(b)) for k, b in zip(rng.integers(-(2**63), 2**63 - 1, 300), rng.integers(16, 4000, 300), strict=True)]
    groups = spark.createDataFrame(rows, "_key long, _bytes long")
    alone, cuts, capacity = sharding.plan_shards(groups, 7)
    ordered = [b for k, b in sorted(rows)]
    assert not alone and capacity == _least(ordered, 7)
    parts = [sum(b for k, b in rows if sum(k >= c for c in cuts) == j) for j in range(7)]
    assert max(parts) == capacity and sum(parts) == sum(ordered)
