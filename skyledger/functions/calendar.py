"""Calendar and clock keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def time_key(ts: Column) -> Column:
    return (F.hour(ts) * 100).cast("int")


def iso_weekday(d: Column) -> Column:
    """1 Monday to 7 Sunday."""
    return (F.weekday(d) + 1).cast("int")


def shift_of(hour: Column) -> Column:
    return F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")


def dim_date(dates: DataFrame) -> DataFrame:
    """One row for each distinct date of column ``date_utc``."""
    d = F.col("date_utc")
    return dates.select("date_utc").filter(d.isNotNull()).distinct().select(
        date_key(d).alias("date_key"), d.alias("date_value"), F.dayofmonth(d).alias("day_of_month"), iso_weekday(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"), F.year(d).alias("year"), iso_weekday(d).isin(6, 7).alias("is_weekend"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    h = F.col("id").cast("int")
    return spark.range(24).select((h * 100).alias("time_key"), F.format_string("%02d:00", h).alias("time_value"), h.alias("hour"), shift_of(h).alias("work_shift"))


def date_chunks(ranges: DataFrame, days: int) -> DataFrame:
    """chunk_start, chunk_end (inclusive, the last one clipped) of every row (start, end)."""
    starts = F.expr(f"explode(sequence(start, end, interval {int(days)} day))")
    return ranges.select("*", starts.alias("chunk_start")).withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), F.col("end"))).drop("start", "end")


def cyclic(ts: Column) -> dict[str, Column]:
    """Sine and cosine of the hour of the day and of the weekday (Sunday 0)."""
    hour, day = F.hour(ts) * (2 * 3.141592653589793 / 24), (F.dayofweek(ts) - 1) * (2 * 3.141592653589793 / 7)
    return {"hour_sin": F.sin(hour), "hour_cos": F.cos(hour), "dow_sin": F.sin(day), "dow_cos": F.cos(day)}
