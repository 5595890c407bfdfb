"""Facts of the star schema: readings, hourly, daily, episodes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import calendar, measures
from skyledger.operators import segments, tables

HOUR_ID = ("location_key", "ts_utc")


def clean(readings: DataFrame, order: list | None = None) -> DataFrame:
    """One row, the first by ``order`` (by default the latest), of each location and hour, with date and time keys."""
    rows = tables.latest(readings, list(HOUR_ID), order or [F.desc("ingested_at"), F.desc("event_id")])
    return rows.withColumns({"date_key": calendar.date_key(F.col("date_utc")), "time_key": calendar.time_key(F.col("ts_utc"))})


def hourly(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"dominant_pollutant": measures.dominant(), "data_completeness": measures.completeness()})


def daily(hours: DataFrame, dominant: str = "first") -> DataFrame:
    """Per location and day: peak, dominant measure ("first" of the day that is known, or that of the "max" index), hours by band."""
    known = F.col("dominant_pollutant").isNotNull()
    by = F.col("ts_utc") if dominant == "first" else F.struct(-F.coalesce("aqi", F.lit(-1)), "ts_utc")
    bands = [F.count_if(measures.in_band(F.col("aqi"), b)).alias(f"{b}_hours") for b in measures.BANDS]
    return hours.groupBy("location_key", "date_utc", "date_key").agg(
        F.max("aqi").alias("aqi_daily_max"), F.min_by("dominant_pollutant", F.when(known, by)).alias("dominant_pollutant_daily"),
        F.count("aqi").alias("hours_measured"), *bands, (F.count("aqi").cast("double") / 24 * 100).alias("data_completeness"),
    )


def _flagged(hours: DataFrame, threshold: int) -> DataFrame:
    """Rows with a known index, flagged at ``threshold`` or more."""
    return hours.filter("aqi is not null").withColumn("flag", (F.col("aqi") >= threshold).cast("int"))


def _gap(before: Column | str, after: Column | str) -> Column:
    return F.timestamp_diff("HOUR", before, after) > 1


def runs(hours: DataFrame, threshold: int, break_on_gap: bool = False) -> DataFrame:
    """Rows with a known index, flagged at ``threshold`` or more, with run_start and run_id (runs counted per location)."""
    x = segments.with_previous(_flagged(hours, threshold), ["flag", "ts_utc"], "_before")
    starts = F.coalesce(F.col("_before.flag"), F.lit(0)) == 0
    if break_on_gap:
        starts = starts | F.coalesce(_gap(F.col("_before.ts_utc"), F.col("ts_utc")), F.lit(False))
    x = x.withColumn("run_start", F.when((F.col("flag") == 1) & starts, 1).otherwise(0)).drop("_before")
    return segments.with_running_sum(x, "run_start", "run_id")


def day_runs(hours: DataFrame, threshold: int = 151, break_on_gap: bool = False) -> DataFrame:
    """Of each location and day with a known index: first_ts, last_ts, first_flag, last_flag and its runs of flagged hours, a
    summary that is joined to those of the days around it by ``joined_runs``."""
    w = Window.partitionBy("location_key", "date_utc").orderBy("ts_utc")
    x = _flagged(hours, threshold).withColumn("_last", F.lag(F.struct("flag", "ts_utc")).over(w))
    starts = F.coalesce(F.col("_last.flag"), F.lit(0)) == 0
    if break_on_gap:
        starts = starts | F.coalesce(_gap(F.col("_last.ts_utc"), F.col("ts_utc")), F.lit(False))
    x = x.withColumn("_run", F.sum(F.when((F.col("flag") == 1) & starts, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = F.struct("start_ts", "end_ts", "peak_aqi", "hours_flagged", "dominant_pollutant")
    known = F.when(F.col("dominant_pollutant").isNotNull(), F.col("ts_utc"))
    parts = x.groupBy("location_key", "date_utc", F.when(F.col("flag") == 1, F.col("_run")).alias("_run")).agg(
        F.min("ts_utc").alias("start_ts"), F.max("ts_utc").alias("end_ts"), F.max("aqi").alias("peak_aqi"), F.count("*").alias("hours_flagged"), F.min_by("dominant_pollutant", known).alias("dominant_pollutant"),
    )
    flagged = F.col("_run").isNotNull()
    return parts.groupBy("location_key", "date_utc").agg(
        F.min("start_ts").alias("first_ts"), F.max("end_ts").alias("last_ts"), F.min_by(flagged, "start_ts").alias("first_flag"), F.max_by(flagged, "end_ts").alias("last_flag"),
        F.sort_array(F.collect_list(F.when(flagged, run))).alias("runs"),  # 12 of a day with 24 hours at most
    )


def joined_runs(days: DataFrame, break_on_gap: bool = False) -> DataFrame:
    """Runs over days: location_key, start_ts, end_ts, peak_aqi, hours_flagged, dominant_pollutant, from summaries of days.

    A run goes on where the last known hour before a day and its first one are flagged. What is compared is one row a day.
    """
    x = segments.with_previous(days, ["last_flag", "last_ts"], "_before", ts="first_ts", clock="date_utc")
    goes_on = F.col("first_flag") & F.coalesce(F.col("_before.last_flag"), F.lit(False))
    if break_on_gap:
        goes_on = goes_on & ~F.coalesce(_gap(F.col("_before.last_ts"), F.col("first_ts")), F.lit(False))
    x = x.filter(F.size("runs") > 0).withColumn("_goes_on", goes_on)
    x = x.withColumn("_new", F.size("runs") - F.col("_goes_on").cast("int"))
    x = segments.with_running_sum(x, "_new", "_upto", ts="first_ts", clock="date_utc")
    parts = x.select("location_key", (F.col("_upto") - F.size("runs")).alias("_offset"), F.posexplode("runs").alias("_i", "run")).select("location_key", (F.col("_offset") + F.col("_i") + 1).alias("_run"), "run.*")
    known = F.when(F.col("dominant_pollutant").isNotNull(), F.col("start_ts"))
    return parts.groupBy("location_key", "_run").agg(
        F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.max("peak_aqi").alias("peak_aqi"), F.sum("hours_flagged").alias("hours_flagged"), F.min_by("dominant_pollutant", known).alias("dominant_pollutant"),
    ).drop("_run")


def long_runs(found: DataFrame, threshold: int, min_hours: int) -> DataFrame:
    """Runs whose inclusive span is ``min_hours`` or more, with their rule."""
    found = found.withColumn("duration_hours", (F.timestamp_diff("HOUR", F.col("start_ts"), F.col("end_ts")) + 1).cast("long")).filter(F.col("duration_hours") >= min_hours)
    return found.withColumns({"start_date": F.to_date("start_ts"), "rule_code": F.lit(f"AQI>={threshold}_{min_hours}h")})


def episodes(hours: DataFrame, threshold: int = 151, min_hours: int = 4, break_on_gap: bool = False) -> DataFrame:
    """Runs of flagged rows whose inclusive span is ``min_hours`` or more, put together from the runs of days."""
    return long_runs(joined_runs(day_runs(hours, threshold, break_on_gap), break_on_gap), threshold, min_hours)


def episodes_touching(start: date, end: date, overlap: bool = False, first: str = "start_date", last: str = "end_ts") -> Column:
    """Episodes that start or end in a range of days; with ``overlap`` also those that span it."""
    begins, ends = F.col(first), F.to_date(last)
    return (begins <= F.lit(end)) & (ends >= F.lit(start)) if overlap else begins.between(start, end) | ends.between(start, end)


def star(hours: DataFrame, dates: DataFrame, times: DataFrame) -> DataFrame:
    """Facts with the columns of their day and clock hour: ``times`` has 24 rows, ``dates`` one a day."""
    return hours.join(F.broadcast(times), "time_key").join(dates, "date_key")
