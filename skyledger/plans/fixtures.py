"""Hourly sensor readings derived from the ``events`` table, as frames and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import facts

OLD = "ts_utc <= TIMESTAMP '2024-01-20 12:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _masked(every: int, value: Column | str, kind: str) -> Column:
    return F.when(F.col("event_id") % every != 0, F.expr(value) if isinstance(value, str) else value).cast(kind)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    index = {"pm25": (11, "floor(value)"), "pm10": (7, "event_id * 37 % 160"), "o3": (5, "event_id * 53 % 120"), "no2": (3, "event_id * 71 % 90"), "so2": (13, "event_id * 29 % 60"), "co": (17, "event_id * 19 % 40")}
    raw = {
        "pm25": (11, "value"), "pm10": (7, "event_id * 37 % 320"), "o3": (5, "event_id * 53 % 240"), "no2": (3, "event_id * 71 % 180"), "so2": (13, "event_id * 29 % 120"), "co": (17, "event_id * 19 % 800"),
        "aod": (19, "cast(event_id % 100 as double) / 100"), "dust": (29, "event_id % 50"), "uv_index": (31, "event_id % 12"), "co2": (37, "400 + event_id % 60"),
    }
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("location_key"), F.date_trunc("hour", ts).alias("ts_utc"), F.to_date(ts).alias("date_utc"), ts.alias("ingested_at"),
        _masked(23, "floor(value * 2)", "int").alias("aqi"),
        *[_masked(n, v, "int").alias(f"aqi_{k}") for k, (n, v) in index.items()],
        *[_masked(n, v, "double").alias(k) for k, (n, v) in raw.items()],
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.clean(readings(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.hourly(clean(spark, sf_dir))


def merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target and source that overlap in three days."""
    rows = clean(spark, sf_dir).select("location_key", "ts_utc", "date_utc", "aqi")
    return rows.filter("date_utc <= DATE '2024-01-20'"), rows.filter("date_utc >= DATE '2024-01-18'").withColumn("aqi", F.col("aqi") + 1)


SQL = """
WITH readings AS (
  SELECT event_id, event_type AS location_key,
    date_trunc('hour', ts) AS ts_utc, CAST(ts AS DATE) AS date_utc, ts AS ingested_at,
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(floor(value * 2) AS INT) END AS aqi,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(floor(value) AS INT) END AS aqi_pm25,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST((event_id * 37) % 160 AS INT) END AS aqi_pm10,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST((event_id * 53) % 120 AS INT) END AS aqi_o3,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST((event_id * 71) % 90 AS INT) END AS aqi_no2,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST((event_id * 29) % 60 AS INT) END AS aqi_so2,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST((event_id * 19) % 40 AS INT) END AS aqi_co,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS pm25,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST((event_id * 37) % 320 AS DOUBLE) END AS pm10,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST((event_id * 53) % 240 AS DOUBLE) END AS o3,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST((event_id * 71) % 180 AS DOUBLE) END AS no2,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST((event_id * 29) % 120 AS DOUBLE) END AS so2,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST((event_id * 19) % 800 AS DOUBLE) END AS co,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(event_id % 100 AS DOUBLE) / 100 END AS aod,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(event_id % 50 AS DOUBLE) END AS dust,
    CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 12 AS DOUBLE) END AS uv_index,
    CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(400 + event_id % 60 AS DOUBLE) END AS co2
  FROM events),
clean AS (
  SELECT *,
    CAST(year(date_utc) * 10000 + month(date_utc) * 100 + day(date_utc) AS INT) AS date_key,
    CAST(hour(ts_utc) * 100 AS INT) AS time_key
  FROM (SELECT *, row_number() OVER (PARTITION BY location_key, ts_utc
                                     ORDER BY ingested_at DESC, event_id DESC) AS rn FROM readings) q
  WHERE rn = 1),
scored AS (
  SELECT *, greatest(coalesce(aqi_pm25, 0), coalesce(aqi_pm10, 0), coalesce(aqi_o3, 0),
                     coalesce(aqi_no2, 0), coalesce(aqi_so2, 0), coalesce(aqi_co, 0)) AS mx
  FROM clean),
hourly AS (
  SELECT *,
    CASE WHEN mx = 0 THEN NULL
         WHEN mx = coalesce(aqi_pm25, 0) THEN 'pm25' WHEN mx = coalesce(aqi_pm10, 0) THEN 'pm10'
         WHEN mx = coalesce(aqi_o3, 0) THEN 'o3'     WHEN mx = coalesce(aqi_no2, 0) THEN 'no2'
         WHEN mx = coalesce(aqi_so2, 0) THEN 'so2'   WHEN mx = coalesce(aqi_co, 0) THEN 'co' END AS dominant_pollutant,
    CAST(count_nn AS DOUBLE) / 10 * 100 AS data_completeness
  FROM (SELECT *,
      CASE WHEN pm25 IS NULL THEN 0 ELSE 1 END + CASE WHEN pm10 IS NULL THEN 0 ELSE 1 END
    + CASE WHEN o3 IS NULL THEN 0 ELSE 1 END + CASE WHEN no2 IS NULL THEN 0 ELSE 1 END
    + CASE WHEN so2 IS NULL THEN 0 ELSE 1 END + CASE WHEN co IS NULL THEN 0 ELSE 1 END
    + CASE WHEN aod IS NULL THEN 0 ELSE 1 END + CASE WHEN dust IS NULL THEN 0 ELSE 1 END
    + CASE WHEN uv_index IS NULL THEN 0 ELSE 1 END + CASE WHEN co2 IS NULL THEN 0 ELSE 1 END AS count_nn
    FROM scored) z)
"""
