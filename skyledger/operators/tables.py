"""Table operators: filters by range, merges and deletes, as functions from frames to frames."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def conform(df: DataFrame, schema: Any) -> DataFrame:
    """The columns of ``schema`` in its order and types; those that are missing are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def in_range(column: str, start: Any = None, end: Any = None) -> Column:
    """Inclusive range; an end that is None is open."""
    tests = [F.col(column) >= F.lit(start)] * (start is not None) + [F.col(column) <= F.lit(end)] * (end is not None)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def same(a: str, b: str, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys])


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``, which must be total."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_nth = 1").drop("_nth")


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``source``, which win at equal keys. Keys of ``source`` must be unique; null keys never match."""
    rest = target.alias("t").join(source.select(*keys).alias("s"), same("t", "s", keys), "left_anti")
    return rest.unionByName(source)


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with those rows of ``source`` whose keys it lacks."""
    return target.unionByName(source.alias("s").join(target.select(*keys).alias("t"), same("s", "t", keys), "left_anti"))


def delete_where(target: DataFrame, gone: Column) -> DataFrame:
    """Rows for which ``gone`` is false or null."""
    return target.filter(~F.coalesce(gone, F.lit(False)))


def replace_range(target: DataFrame, source: DataFrame, gone: Column) -> DataFrame:
    return delete_where(target, gone).unionByName(source)


@dataclass(frozen=True)
class NewData:
    """What an incremental run has to read. ``full``: the target is empty; no ``rows``: nothing is new."""

    full: bool
    start: date | None
    end: date | None
    rows: int


def _after(mark: Any, ts: str, day: str | None) -> Column:
    """Rows later than ``mark`` (None: all), as literals, so that the scan prunes days and row groups."""
    if mark is None:
        return F.lit(True)
    later = F.col(ts) > F.lit(mark)
    return later & (F.col(day) >= F.lit(mark.date())) if day and isinstance(mark, datetime) else later


def new_data(source: DataFrame, target: DataFrame, ts: str = "ts_utc", day: str = "date_utc") -> DataFrame:
    """One row: watermark (of ``target``), min_date, max_date, new_rows of the rows of ``source`` after it."""
    mark = target.agg(F.max(ts)).first()[0]
    found = source.filter(_after(mark, ts, day if day != ts else None))
    kind = source.schema[ts].dataType
    return found.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.count("*").alias("new_rows")).select(F.lit(mark).cast(kind).alias("watermark"), "*")


def new_data_range(source: DataFrame, target: DataFrame, ts: str = "ts_utc", day: str = "date_utc") -> NewData:
    row = new_data(source, target, ts, day).first()
    return NewData(row["watermark"] is None, row["min_date"], row["max_date"], row["new_rows"])


def new_data_by_key(source: DataFrame, target: DataFrame, keys: list[str], ts: str = "ts_utc", day: str = "date_utc") -> DataFrame:
    """Like ``new_data`` with a watermark for each key, so that a key that lags behind is not passed over: a row for each key."""
    marks = target.groupBy(*keys).agg(F.max(ts).alias("watermark"))
    later = source.select(*keys, ts, day).join(marks, keys, "left").filter(F.col("watermark").isNull() | (F.col(ts) > F.col("watermark")))
    return later.groupBy(*keys, "watermark").agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.count("*").alias("new_rows"))


def after_watermark(source: DataFrame, target: DataFrame, ts: str = "ts_utc", day: str | None = None) -> DataFrame:
    return source.filter(_after(target.agg(F.max(ts)).first()[0], ts, day))


def drop_future(df: DataFrame, now: datetime, ts: str = "ts_utc") -> DataFrame:
    return df.filter(F.col(ts) <= F.lit(now))
