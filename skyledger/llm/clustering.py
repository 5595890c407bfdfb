"""Centroid clustering of integer vectors: Lloyd rounds whose search for the nearest centroid runs over Walsh-Hadamard
coefficients from coarse to fine.

The transform H is exact on integers and keeps distances up to a factor: |Hv - Hc|^2 = dim |v - c|^2. So sums of squared
differences over some coefficients bound a distance from below, and over all of them give it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, ship

#: Components x become floor(SCALE * x), which must lie within LIMIT: squared distances of coefficients then fit 64 bits.
SCALE, LIMIT = 256, 1 << 24
#: Vectors that are compared at once.
BLOCK = 1024


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, its coefficients in order of their sign changes. Its own inverse up to the row's length."""
    n, dim = x.shape
    h = 1
    while h < dim:
        x = x.reshape(n, dim // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, dim)
        h *= 2
    return x[:, sequency(dim)]


def sequency(dim: int) -> np.ndarray:
    """Rows of the transform, those with few sign changes first."""
    i = np.arange(dim)
    reverse = sum(((i >> b) & 1) << (dim.bit_length() - 2 - b) for b in range(dim.bit_length() - 1)) if dim > 1 else i
    gray = i ^ (i >> 1)
    return np.asarray(reverse)[gray]


def inverse(y: np.ndarray) -> np.ndarray:
    """Integer vectors from their coefficients, or sums of them from sums."""
    back = np.empty_like(y)
    back[:, sequency(y.shape[1])] = y
    plain = transform(back)
    out = np.empty_like(plain)
    out[:, sequency(y.shape[1])] = plain
    return out // y.shape[1]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each row, all as coefficients; of equal ones the smallest number.

    Each pass takes four times the coefficients of all before. The centroid that is ahead is measured to the end, and those
    whose sums already lie beyond that are given up; equal ones stay, so ties are seen.
    """
    n, dim = x.shape
    k = len(centroids)
    row, col, sums = np.repeat(np.arange(n), k), np.tile(np.arange(k), n), np.zeros(n * k, np.int64)
    bound = np.full(n, np.iinfo(np.int64).max)
    at, to = 0, min(4, dim)
    while True:
        sums = sums + ((x[row, at:to] - centroids[col, at:to]) ** 2).sum(1)
        first = np.searchsorted(row, np.arange(n))
        least = np.minimum.reduceat(sums, first)
        ahead = np.flatnonzero(sums == least[row])
        ahead = ahead[np.searchsorted(row[ahead], np.arange(n))]
        if to == dim:
            return col[ahead].astype(np.int32), sums[ahead] // dim
        rest = ((x[:, to:] - centroids[col[ahead], to:]) ** 2).sum(1)
        bound = np.minimum(bound, sums[ahead] + rest)
        stays = sums <= bound[row]
        row, col, sums = row[stays], col[stays], sums[stays]
        at, to = to, min(4 * to, dim)


def _coefficients(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("coefs").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _assigned(coefs: DataFrame, centroids: list[list[int]], dim: int) -> DataFrame:
    """vec_id, cluster, distance."""
    goal = transform(np.array(centroids, np.int64))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _coefficients(b, dim)
            for i in range(0, len(x), BLOCK):
                cluster, distance = nearest(x[i : i + BLOCK], goal)
                yield pa.RecordBatch.from_pydict({"vec_id": b.column("vec_id").slice(i, BLOCK), "cluster": cluster, "distance": distance})

    return coefs.mapInArrow(assign, f"vec_id {dict(coefs.dtypes)['vec_id']}, cluster int, distance long")


def _moved(coefs: DataFrame, centroids: list[list[int]], dim: int) -> list[list[int]]:
    """The centroids after one round. A task gives one row a cluster, so what is shuffled does not grow with the vectors."""
    goal = transform(np.array(centroids, np.int64))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(goal), np.int64), np.zeros((len(goal), dim), np.int64)
        for b in batches:
            x = _coefficients(b, dim)
            for i in range(0, len(x), BLOCK):
                cluster, _ = nearest(x[i : i + BLOCK], goal)
                n += np.bincount(cluster, minlength=len(goal))
                np.add.at(total, cluster, x[i : i + BLOCK])
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"cluster": held.astype(np.int32), "n": n[held], "total": pa.array(list(total[held]), pa.list_(pa.int64()))})

    parts = coefs.mapInArrow(sums, "cluster int, n long, total array<long>")
    parts = parts.select("cluster", "n", F.posexplode("total").alias("i", "t"))
    found = parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    new, total = list(centroids), np.zeros((len(goal), dim), dtype=object)
    n = [0] * len(goal)
    for r in found.collect():  # one row a component of a centroid
        total[r["cluster"], r["i"]], n[r["cluster"]] = r["t"], r["n"]
    for c, whole in enumerate(inverse(total)):
        if n[c]:
            new[c] = [int(t) // n[c] for t in whole]
    return new


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dim: int = 64, column: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia (distances summed over the cluster, over all),
    centroid_sha256 (of the final centroid's components as decimal integers joined by commas) of each vector of ``dim``
    components, a power of two, none null or not finite. Other vectors, also null ones, are left out.

    Components become integers floor(256 x); one beyond 2**24 is an error, as its distances need not fit a long. The first
    centroids are the ``k`` vectors with the smallest sha256 of seed and vec_id, or all where there are fewer; rows of equal
    or null ids are vectors of their own, in order of their components. A round moves each centroid that has vectors to the
    floor of their mean. An empty table gives an empty result. Other columns are ignored.
    """
    ship(vectors.sparkSession)
    x = F.col(column).cast("array<double>")
    good = (F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.when(F.abs(v) * SCALE < LIMIT, F.floor(v * SCALE)).otherwise(F.raise_error(F.lit("a component beyond 2**24 / 256")).cast("long")))
    kept = vectors.filter(F.coalesce(good, F.lit(False))).select("vec_id", whole.alias("v"))

    def coefficients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = transform(b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.ListArray.from_arrays(np.arange(len(y) + 1, dtype=np.int32) * dim, y.reshape(-1))], ["vec_id", "coefs"])

    kind = dict(kept.dtypes)["vec_id"]
    coefs = materialize(kept.mapInArrow(coefficients, f"vec_id {kind}, coefs array<long>"), "cluster-coefs")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = [list(r["v"]) for r in kept.select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()]  # k rows
    for _ in range(rounds if centroids else 0):
        centroids = _moved(coefs, centroids, dim)
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long, {names.removeprefix('cluster int, ')}")
    found = materialize(_assigned(coefs, centroids, dim), "cluster-assigned")
    inertia = {r["cluster"]: r["n"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # k rows at most
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    said = vectors.sparkSession.createDataFrame([(c, n, sum(inertia.values()), shas[c]) for c, n in inertia.items()], names)
    return found.join(F.broadcast(said), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
