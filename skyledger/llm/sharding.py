"""Sharding into byte-balanced shards by minimax contiguous partition; groups of equal texts stay together.

The groups are put in a fixed order (by text hash, groups above the fair share first), the smallest feasible shard
capacity is found by binary search with a greedy check, and the order is cut there. The driver sees runs of neighbouring
groups, at most ``n_shards * RUNS_PER_SHARD`` at any corpus size. Where a cut may fall inside a run, the run is read again
in finer ones, until the capacity is that of the single groups.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import materialize

#: Runs of groups a shard is resolved into at once; bounds what reaches the driver.
RUNS_PER_SHARD = 2000
#: Prefix sums go by the top 12 bits of the hash: 4,096 totals, then a window in each bucket.
BUCKET_BITS = 12
#: Parts of a shard for numbering, so that no task holds a whole shard.
SLOT_PARTS = 256
OVERHEAD = 16


def with_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size in bytes with overhead, text_crc32, and the hash of the text that names its group (null text: as empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_key"))


def group_offsets(groups: DataFrame) -> DataFrame:
    """Adds ``_start``: the bytes of all groups before this one in hash order. groups: _key, _bytes."""
    bucket = F.shiftright("_key", 64 - BUCKET_BITS)
    groups = groups.withColumn("_bucket", bucket)
    totals = groups.groupBy("_bucket").agg(F.sum("_bytes").alias("_total"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_bucket").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    return groups.join(F.broadcast(totals), "_bucket").withColumn("_start", F.col("_base") + F.coalesce(F.sum("_bytes").over(inside), F.lit(0))).drop("_bucket", "_base")


class Runs:
    """Runs of neighbouring groups in order: where each starts, its first key, its number of groups. They may be cut between
    groups only, and where a run holds several, it is not known yet where those are."""

    def __init__(self, rows: list[tuple[int, int, int]], total: int) -> None:
        self.rows, self.total = sorted(rows), total
        self.starts = [r[0] for r in self.rows]

    def cuts(self, capacity: int, shards: int, hope: bool) -> list[int]:
        """Where greedy shards end. Cuts lie between runs; with ``hope`` also anywhere in a run of several groups, so that the
        true cuts lie between the ones and the others."""
        at, out = 0, []
        for _ in range(shards):
            limit = at + capacity
            if limit >= self.total:
                return [*out, self.total]
            i = bisect_right(self.starts, limit) - 1
            at = max(at, limit if hope and self.rows[i][2] > 1 else self.starts[i])
            out.append(at)
        return out

    def least(self, shards: int, hope: bool) -> int:
        """The smallest capacity that needs no more than ``shards``."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, hope)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def open(self, low: int, high: int, shards: int) -> list[tuple[int, int]]:
        """Stretches (from, to) in which cuts for these capacities may lie, as whole runs of which one at least has several groups."""
        sure, hope = self.cuts(low, shards, False), self.cuts(high, shards, True)
        ends = [*self.starts[1:], self.total]
        out: list[tuple[int, int]] = []
        for j, most in enumerate(hope):
            first = bisect_right(self.starts, sure[min(j, len(sure) - 1)]) - 1
            last = bisect_right(self.starts, min(most, self.total - 1)) - 1
            several = [i for i in range(min(first, last), last + 1) if self.rows[i][2] > 1]
            out += [(self.starts[i], ends[i]) for i in several]
        return sorted(set(out))


def _runs(groups: DataFrame, width: int, stretches: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Start, first key and number of groups of runs of ``width`` bytes in the stretches."""
    merged: list[list[int]] = []
    for a, b in stretches:
        if merged and merged[-1][1] == a:
            merged[-1][1] = b
        else:
            merged.append([a, b])
    which = F.lit(None).cast("int")
    for i, (a, b) in enumerate(merged):
        which = F.when((F.col("_start") >= a) & (F.col("_start") < b), i).otherwise(which)
    runs = groups.withColumn("_which", which).filter("_which is not null").groupBy("_which", F.expr(f"_start div {width}L").alias("_at"))
    runs = runs.agg(F.min("_start").alias("start"), F.min("_key").alias("key"), F.count("*").alias("n"))
    return [(r["start"], r["key"], r["n"]) for r in runs.collect()]


def plan_shards(groups: DataFrame, n_shards: int) -> tuple[list[int], list[int], int]:
    """Keys of the groups that fill a shard of their own (largest first), the first keys of all but the first shard of the rest,
    and the capacity of these."""
    left = groups.agg(F.sum("_bytes").alias("b")).first()["b"] or 0
    alone, k = [], n_shards
    # At most n_shards groups can exceed the fair share.
    for row in groups.orderBy(F.desc("_bytes"), "_key").limit(n_shards).collect():
        if k == 1 or row["_bytes"] * k <= left:
            break
        alone.append(row["_key"])
        left, k = left - row["_bytes"], k - 1
    if not left:
        return alone, [], 0
    rest = materialize(group_offsets(groups.filter(~F.col("_key").isin(alone)) if alone else groups), "sharding-offsets")
    most = k * RUNS_PER_SHARD
    width = max(1, -(-left // most))
    runs = Runs(_runs(rest, width, [(0, left)]), left)
    while (low := runs.least(k, True)) < (high := runs.least(k, False)):
        stretches = runs.open(low, high, k)
        width = max(1, min(sum(b - a for a, b in stretches) // most, width // 2))
        finer = _runs(rest, width, stretches)
        gone = {a for a, _ in stretches}
        runs = Runs([r for r in runs.rows if r[0] not in gone] + finer, left)
    first = {start: key for start, key, _ in runs.rows}
    return alone, [first[at] for at in runs.cuts(high, k, False)[:-1]], high


def shard_of(alone: list[int], cuts: list[int]) -> Column:
    key, shard = F.col("_key"), F.lit(len(alone))
    for c in cuts:
        shard = shard + (key >= F.lit(c)).cast("int")
    for i, a in reversed(list(enumerate(alone))):
        shard = F.when(key == F.lit(a), F.lit(i)).otherwise(shard)
    return shard.cast("int")


def number_slots(sharded: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard: offsets of SLOT_PARTS parts by hashed id, then a row number in each part."""
    parted = sharded.withColumn("_part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_PARTS)))
    # Rows equal in every column hash alike; they are exchangeable, and a random digit would not survive a retry.
    counts = parted.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    order = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "_key")
    return parted.join(F.broadcast(offsets), ["shard", "_part"]).withColumn("slot", F.col("_base") + F.row_number().over(order) - 1).drop("_part", "_base")


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs`` (doc_id, text; other columns are ignored).

    Equal texts share a shard (null counts as empty). A group above the fair share of what is left gets a shard alone,
    the minimax cut spreads the rest over the others. Null or repeated ids and repeated rows are placed as rows of their
    own; an empty table gives an empty result. Two texts whose 64-bit hashes agree would share a group, which breaks nothing.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    sized = materialize(with_sizes(docs), "sharding-sizes")
    groups = materialize(sized.groupBy("_key").agg(F.sum("size").alias("_bytes")), "sharding-groups")
    alone, cuts, _ = plan_shards(groups, n_shards)
    return number_slots(sized.withColumn("shard", shard_of(alone, cuts))).select("doc_id", "size", "text_crc32", "shard", "slot")
