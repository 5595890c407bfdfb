"""Windows over long series in segments: a location's rows are dealt out by month, each segment is scanned alone, and one small
row a segment carries what it needs of the others. No task holds a location's whole history, only a row for each of its months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a segment is, as a unit of time of the clock.
SEGMENT = "month"


def _segment(clock: Column | str) -> Column:
    return F.date_trunc(SEGMENT, clock).alias("_segment")


def _cut(df: DataFrame, clock: str) -> DataFrame:
    return df.withColumn("_segment", _segment(F.col(clock)))


def _carried(df: DataFrame, carry: DataFrame) -> DataFrame:
    """``df`` with the columns of its segment's row; a null location or time is a segment as any."""
    same = F.col("d.location_key").eqNullSafe(F.col("c.location_key")) & F.col("d._segment").eqNullSafe(F.col("c._segment"))
    rest = [F.col(f"c.{c}") for c in carry.columns if c not in ("location_key", "_segment")]
    return df.alias("d").join(carry.alias("c"), same, "left").select("d.*", *rest)


def with_previous(df: DataFrame, columns: list[str], name: str, ts: str = "ts_utc", clock: str = "ts_utc") -> DataFrame:
    """``df`` with ``name``, a struct of ``columns`` of the row before in the location by ``ts``; null at the first.

    ``clock`` tells the segment, in the order of ``ts``.
    """
    cut = _cut(df, clock)
    value = F.struct(*columns)
    ends = cut.groupBy("location_key", "_segment").agg(F.max_by(value, ts).alias("_end"))
    carry = ends.withColumn("_end", F.lag("_end").over(Window.partitionBy("location_key").orderBy("_segment")))
    own = F.lag(value).over(Window.partitionBy("location_key", "_segment").orderBy(ts))
    return _carried(cut.withColumn(name, own), carry).withColumn(name, F.coalesce(F.col(name), F.col("_end"))).drop("_segment", "_end")


def with_running_sum(df: DataFrame, column: str, name: str, ts: str = "ts_utc", clock: str = "ts_utc") -> DataFrame:
    """``df`` with ``name``, the sum of ``column`` over the location's rows up to this one."""
    cut = _cut(df, clock)
    before = Window.partitionBy("location_key").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carry = cut.groupBy("location_key", "_segment").agg(F.sum(column).alias("_sum")).withColumn("_sum", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    own = F.sum(column).over(Window.partitionBy("location_key", "_segment").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0))
    return _carried(cut.withColumn(name, own), carry).withColumn(name, F.col(name) + F.col("_sum")).drop("_segment", "_sum")


def with_lead(df: DataFrame, column: str, ahead: int, name: str, ts: str = "ts_utc") -> DataFrame:
    """``df`` with ``name``, the value of ``column`` ``ahead`` rows later in the location; null where there is none.

    Each segment carries the first ``ahead`` values of those after it.
    """
    cut = _cut(df, ts)
    by = Window.partitionBy("location_key", "_segment").orderBy(ts)
    cut = cut.withColumns({"_nth": F.row_number().over(by), "_own": F.lead(F.struct(column), ahead).over(by)})
    value = F.when(F.col("_nth") <= ahead, F.struct("_nth", F.col(column).alias("v")))
    heads = cut.groupBy("location_key", "_segment").agg(F.count("*").alias("_n"), F.sort_array(F.collect_list(value)).alias("_heads"))
    after = Window.partitionBy("location_key").orderBy("_segment").rowsBetween(1, ahead)
    carry = heads.select("location_key", "_segment", "_n", F.slice(F.flatten(F.collect_list("_heads").over(after)), 1, ahead).alias("_next"))
    at = F.col("_nth") + ahead - F.col("_n")
    later = F.when(F.col("_own").isNotNull(), F.col(f"_own.{column}")).otherwise(F.get(F.col("_next"), (at - 1).cast("int"))["v"])
    return _carried(cut, carry).withColumn(name, later).drop("_segment", "_nth", "_own", "_n", "_next")


def with_percent_rank(df: DataFrame, name: str, ts: str = "ts_utc") -> DataFrame:
    """``df`` with ``name``, (rank - 1) / (rows - 1) by ``ts`` in the location, 0 where there is one row. Equal times are in one segment."""
    cut = _cut(df, ts)
    by = Window.partitionBy("location_key").orderBy("_segment")
    sizes = cut.groupBy("location_key", "_segment").agg(F.count("*").alias("_n"))
    before, whole = F.sum("_n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.sum("_n").over(Window.partitionBy("location_key"))
    carry = sizes.select("location_key", "_segment", F.coalesce(before, F.lit(0)).alias("_before"), whole.alias("_all"))
    own = F.rank().over(Window.partitionBy("location_key", "_segment").orderBy(ts))
    rank = (F.col("_rank") - 1 + F.col("_before")) / F.nullif(F.col("_all") - 1, F.lit(0))
    return _carried(cut.withColumn("_rank", own), carry).withColumn(name, F.coalesce(rank, F.lit(0.0))).drop("_segment", "_rank", "_before", "_all")
