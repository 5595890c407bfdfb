"""Data-quality checks: each gives rows (check, passed, value)."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _report(name: str, value: DataFrame, passed: Column) -> DataFrame:
    """``value`` has one row with a column value."""
    return value.select(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"), F.col("value").cast("double").alias("value"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    n = df.groupBy(*keys).count().filter("count > 1").agg(F.count("*").alias("value"))
    return _report("duplicates", n, F.col("value") == 0)


def nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return _report("nulls", df.agg(F.count_if(F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull()).alias("value")), F.col("value") == 0)


def value_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return _report("range", df.agg(F.count_if(~F.col(column).between(low, high)).alias("value")), F.col("value") == 0)


def freshness(df: DataFrame, now: datetime, max_hours: float, ts: str = "ts_utc") -> DataFrame:
    lag = df.agg(((F.lit(now).cast("timestamp").cast("long") - F.max(ts).cast("long")) / 3600).alias("value"))
    return _report("freshness", lag, F.col("value") < max_hours)


def retention(source: DataFrame, target: DataFrame, least: float) -> DataFrame:
    ratio = source.agg(F.count("*").alias("s")).join(F.broadcast(target.agg(F.count("*").alias("t")))).select((F.col("t") / F.nullif("s", F.lit(0))).alias("value"))
    return _report("retention", ratio, F.col("value") >= least)


def referential(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    lost = fact.select(key).join(dim.select(key), key, "left_anti").agg(F.count("*").alias("value"))
    return _report("referential", lost, F.col("value") == 0)


def fact_rules(daily: DataFrame, bands: list[str]) -> DataFrame:
    total = sum((F.col(b) for b in bands), F.lit(0))
    bad = (F.col("hours_measured") > 24) | ~F.col("data_completeness").between(0, 100) | (total > F.col("hours_measured"))
    return _report("fact_rules", daily.agg(F.count_if(bad).alias("value")), F.col("value") == 0)


def schema_matches(df: DataFrame, schema: StructType, name: str = "schema") -> DataFrame:
    """``value``: columns of the rows that are missing, of another type, out of place or not foreseen. The rows are read."""
    found, wanted = ([(f.name, f.dataType) for f in s.fields] for s in (df.schema, schema))
    wrong = sum(a != b for a, b in zip(found, wanted, strict=False)) + abs(len(found) - len(wanted))
    return _report(name, df.agg(F.count("*").alias("n")).select(F.lit(wrong).alias("value")), F.col("value") == 0)


@dataclass(frozen=True)
class Gate:
    """What rows must meet to go on. ``rules``: name and what must hold of a row, where null is a breach; ``keys`` must be
    unique; the latest ``clock`` must be less than ``max_hours`` before ``now``; ``least`` of the source's rows must be there; keys of
    ``dims`` (column to dimension) must be known. ``tolerated``: share of rows that may break rules before the gate shuts."""

    rules: dict[str, Column] = field(default_factory=dict)
    keys: tuple[str, ...] = ("location_key", "ts_utc")
    clock: str = "ts_utc"
    now: datetime | None = None
    max_hours: float | None = None
    least: float | None = None
    dims: dict[str, DataFrame] = field(default_factory=dict)
    tolerated: float = 0.0

    def flagged(self, rows: DataFrame) -> DataFrame:
        """``rows`` with broken, the names of the rules that each breaks. Dimensions are joined as their sizes allow."""
        tests = {name: F.coalesce(test, F.lit(False)) for name, test in self.rules.items()}
        for i, (column, dim) in enumerate(self.dims.items()):
            known = dim.select(F.col(column).alias(f"_dim{i}")).distinct()
            rows = rows.join(known, F.col(column) == F.col(f"_dim{i}"), "left")
            tests[f"referential {column}"] = F.col(f"_dim{i}").isNotNull()
        broken = F.array_compact(F.array(*[F.when(~test, F.lit(name)) for name, test in tests.items()])) if tests else F.array().cast("array<string>")
        return rows.withColumn("broken", broken).drop(*[f"_dim{i}" for i in range(len(self.dims))])

    def report(self, flagged: DataFrame, source_rows: int | None = None) -> DataFrame:
        """check, passed, value of all checks: one scan of the rows and one shuffle, by key, of their counts."""
        names = [*self.rules, *(f"referential {c}" for c in self.dims)]
        by_key = flagged.groupBy(*self.keys).agg(F.count("*").alias("n"), F.max(self.clock).alias("last"), *[F.count_if(F.array_contains("broken", n)).alias(f"r{i}") for i, n in enumerate(names)])
        lag = ((F.lit(self.now).cast("timestamp").cast("long") - F.max("last").cast("long")) / 3600) if self.now else F.lit(None)
        seen = by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 1).alias("twice"), lag.cast("double").alias("lag"), *[F.coalesce(F.sum(f"r{i}"), F.lit(0)).alias(f"r{i}") for i in range(len(names))])
        row = lambda name, value, passed: F.struct(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"), value.cast("double").alias("value"))
        found = [row("duplicates", F.col("twice"), F.col("twice") == 0)]
        found += [row(n, F.col(f"r{i}"), F.col(f"r{i}") <= self.tolerated * F.col("n")) for i, n in enumerate(names)]
        found += [row("freshness", F.col("lag"), F.col("lag") < self.max_hours)] * (self.max_hours is not None)
        if self.least is not None and source_rows is not None:
            share = F.col("n") / F.nullif(F.lit(source_rows), F.lit(0))
            found.append(row("retention", share, share >= self.least))
        return seen.select(F.explode(F.array(*found)).alias("x")).select("x.*")
