"""op11: the search against plain distances, rounds against plain Python, odd rows."""

import hashlib

import numpy as np
import oracle
import pytest

from skyledger.llm import clustering, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("dim", [1, 2, 64])
def test_search_equals_plain_distances(dim):
    rng = np.random.default_rng(dim)
    for spread in (1, 4, 300, (1 << 24) - 1):
        x, c = (rng.integers(-spread, spread + 1, (n, dim)) for n in (500, 40))
        c[7] = c[3]
        plain = ((x[:, None].astype(object) - c[None].astype(object)) ** 2).sum(2)
        cluster, distance = clustering.nearest(clustering.transform(x), clustering.transform(c))
        assert (cluster == plain.argmin(1)).all() and (distance == plain.min(1)).all()


def test_transform_is_exact_and_ordered():
    x = np.random.default_rng(1).integers(-1000, 1000, (50, 64))
    y = clustering.transform(x)
    assert (clustering.inverse(y) == x).all()
    assert ((y**2).sum(1) == 64 * (x**2).sum(1)).all()
    rows = clustering.transform(np.eye(64, dtype=np.int64)).T
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(64))


def test_query(spark):
    assert oracle.compare(queries.op11_cluster_centroids(spark, SF), queries.ORACLE_SQL["op11_cluster_centroids"], SF) is None


def _plain(rows, k, rounds):
    kept = [(i, [int(np.floor(256 * np.float64(c))) for c in v]) for i, v in rows if v is not None and len(v) == 4 and all(c is not None and np.isfinite(c) for c in v)]
    named = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(((named(i), v) for i, v in kept))[:k]]
    for r in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in cents] for _, v in kept]
        at = [d.index(min(d)) for d in far]
        if r < rounds:
            groups = [[v for (_, v), j in zip(kept, at, strict=True) if j == c] for c in range(len(cents))]
            cents = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, cents, strict=True)]
    dist = [min(d) for d in far]
    own = lambda c: sum(d for d, j in zip(dist, at, strict=True) if j == c)
    return [(i, c, d, own(c), sum(dist), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for (i, _), c, d in zip(kept, at, dist, strict=True)]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=4)]) for i in range(60)]
    rows += [(i, rows[0][1]) for i in range(100, 160)] + [(7, [0.0, -0.001, 1 / 3, 65535.0]), (7, rows[1][1]), (None, rows[2][1]), (None, rows[3][1])]
    bad = [(201, None), (202, []), (203, [1.0, 2.0]), (204, [1.0, None, 2.0, 3.0]), (205, [nan, 1.0, 1.0, 1.0]), (206, [1.0, inf, 1.0, 1.0]), (207, [1.0] * 5)]
    names = ["coefs", "v", "cluster", "distance", "total", "h", "n", "i", "a.b"]
    frame = lambda r: spark.createDataFrame([(*x, *names) for x in r], "vec_id long, embedding array<double>, " + ", ".join(f"`{n}` string" for n in names))
    got = clustering.cluster_vectors(frame(rows + bad), k=5, dim=4)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, _plain(rows + bad, 5, 5)))
    few = clustering.cluster_vectors(frame(rows[:3]), k=40, dim=4)
    assert sorted(map(str, map(tuple, few.collect()))) == sorted(map(str, _plain(rows[:3], 40, 5)))
    none = clustering.cluster_vectors(frame(bad), k=5, dim=4)
    assert none.columns == got.columns and none.count() == clustering.cluster_vectors(frame([]), dim=4).count() == 0
    with pytest.raises(Exception, match="beyond"):
        clustering.cluster_vectors(frame([(1, [1e9, 0.0, 0.0, 0.0])]), dim=4).collect()
