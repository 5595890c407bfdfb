"""Reports over tables: counts, coverage, histograms, latest rows, state of a layer against its source."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of rows already done, in percent, and what it is called.
RATINGS = ((90, "excellent"), (70, "good"), (50, "fair"))


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(frames: dict[str, DataFrame], label: str = "layer") -> DataFrame:
    """``label`` and n of each frame."""
    return union([df.agg(F.lit(name).alias(label), F.count("*").alias("n")) for name, df in frames.items()])


def latest_per_key(df: DataFrame, key: str = "location_key", ts: str = "ts_utc") -> DataFrame:
    return df.groupBy(key).agg(F.max(ts).alias("latest"))


def key_counts(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """Rows and distinct values of ``column`` of each key."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(column).alias(name))


def histogram(df: DataFrame, value: Column, width: float, name: str = "bucket") -> DataFrame:
    """Rows by multiples of ``width``, each with what lies nearest to it; nulls are left out."""
    return df.filter(value.isNotNull()).groupBy((F.floor(value / width + 0.5) * width).cast("long").alias(name)).agg(F.count("*").alias("n"))


def bins(df: DataFrame, value: Column, width: float) -> DataFrame:
    """Rows by number of the bin [bin * width, (bin + 1) * width)."""
    return df.groupBy(F.floor(value / width).alias("bin")).agg(F.count("*").alias("n"))


def coverage(df: DataFrame, *by: str, ts: str = "ts_utc") -> DataFrame:
    return df.groupBy(*by).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(ts).alias("n"))


def first_rows(df: DataFrame, order: list[Column | str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by a total order."""
    return df.orderBy(*order).limit(n)


def rows_per_date(df: DataFrame, day: str = "date_utc") -> DataFrame:
    return df.groupBy(day).agg(F.count("*").alias("n"))


def layer_status(source: DataFrame, target: DataFrame, name: str, source_ts: str = "ts_utc", target_ts: str = "ts_utc") -> DataFrame:
    """name, source_rows, target_rows, source_latest, target_latest, pending (rows of the source after the target's last), savings
    (percent that an incremental run leaves out), rating. An empty target has all rows pending."""
    last = target.agg(F.count("*").alias("target_rows"), F.max(target_ts).alias("target_latest"))
    mark: Any = last.first()["target_latest"]
    later = F.col(source_ts) > F.lit(mark) if mark is not None else F.lit(True)
    rows = source.agg(F.count("*").alias("source_rows"), F.max(source_ts).alias("source_latest"), F.count_if(later).alias("pending"))
    return rated(rows.join(F.broadcast(last)).select(F.lit(name).alias("name"), "*"))  # one row each


def rated(rows: DataFrame) -> DataFrame:
    """name, source_rows, target_rows, source_latest, target_latest, pending with savings and rating."""
    share = 100 * (F.col("source_rows") - F.col("pending")).cast("double") / F.nullif("source_rows", F.lit(0))
    rating = reduce(lambda c, r: c.when(share >= r[0], r[1]), RATINGS, F.when(share.isNull(), "poor")).otherwise("poor")
    latest = [F.col(c).cast("timestamp").alias(c) for c in ("source_latest", "target_latest")]
    return rows.select("name", "source_rows", "target_rows", *latest, "pending", F.round(share, 6).alias("savings"), rating.alias("rating"))


def status_total(layers: list[DataFrame]) -> DataFrame:
    """Rows of ``layer_status`` and one more, named total."""
    each = union(layers)
    sums = each.agg(*[F.sum(c).alias(c) for c in ("source_rows", "target_rows", "pending")], F.max("source_latest").alias("source_latest"), F.max("target_latest").alias("target_latest"))
    return each.unionByName(rated(sums.withColumn("name", F.lit("total"))))
