"""The tables of the three layers: columns, keys, partitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    layer: str
    name: str
    ddl: str
    keys: tuple[str, ...]
    by: tuple[str, ...] = ()
    #: Column of time that tells how far the table has come.
    clock: str | None = None
    #: Partition columns that follow from the keys, with the SQL that gives them.
    derived: tuple[tuple[str, str], ...] = ()
    #: Columns that say where rows changed; their values are logged with each write.
    logged: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def by_keys(self) -> bool:
        """Whether rows of one key always lie in one partition."""
        return set(self.by) <= {*self.keys, *(c for c, _ in self.derived)}


# Facts are partitioned by day alone and sorted by location within: by day and location a partition would hold 24 rows.
_HOURS = {"keys": ("location_key", "ts_utc"), "by": ("date_utc",), "clock": "ts_utc", "derived": (("date_utc", "to_date(ts_utc)"),), "logged": ("location_key", "date_utc")}

#: Names, order and types of stored columns.
READINGS = Table("bronze", "readings", """
    location_key string, ts_utc timestamp, date_utc date, latitude double, longitude double,
    aqi int, aqi_pm25 int, aqi_pm10 int, aqi_no2 int, aqi_o3 int, aqi_so2 int, aqi_co int,
    pm25 double, pm10 double, o3 double, no2 double, so2 double, co double, aod double, dust double, uv_index double, co2 double,
    model_domain string, request_timezone string, _ingested_at timestamp""", **_HOURS)  # fmt: skip
CLEAN = Table("silver", "clean", """
    location_key string, ts_utc timestamp, date_utc date, date_key int, time_key int,
    aqi int, aqi_pm25 int, aqi_pm10 int, aqi_no2 int, aqi_o3 int, aqi_so2 int, aqi_co int,
    pm25 double, pm10 double, o3 double, no2 double, so2 double, co double, aod double, dust double, uv_index double, co2 double,
    model_domain string, request_timezone string, _ingested_at timestamp""", **_HOURS)  # fmt: skip
HOURLY = Table("gold", "hourly", """
    record_id string, location_key string, ts_utc timestamp, date_utc date, date_key int, time_key int,
    aqi int, aqi_pm25 int, aqi_pm10 int, aqi_no2 int, aqi_o3 int, aqi_so2 int, aqi_co int,
    pm25 double, pm10 double, o3 double, no2 double, so2 double, co double, aod double, dust double, uv_index double, co2 double,
    dominant_pollutant string, data_completeness double""", **_HOURS)  # fmt: skip
DAILY = Table("gold", "daily", """
    daily_record_id string, location_key string, date_utc date, date_key int, aqi_daily_max int, dominant_pollutant_daily string,
    hours_in_cat_good int, hours_in_cat_moderate int, hours_in_cat_usg int, hours_in_cat_unhealthy int, hours_in_cat_very_unhealthy int, hours_in_cat_hazardous int,
    hours_measured int, data_completeness double""", ("location_key", "date_utc"), ("date_utc",), "date_utc")  # fmt: skip
EPISODES = Table("gold", "episodes", """
    episode_id string, location_key string, start_ts_utc timestamp, end_ts_utc timestamp, start_date_utc date, duration_hours int,
    peak_aqi int, hours_flagged int, dominant_pollutant string, rule_code string""",
    ("location_key", "start_ts_utc"), ("start_date_utc",), "end_ts_utc", (("start_date_utc", "to_date(start_ts_utc)"),))
DIM_DATE = Table(
    "gold", "dim_date", "date_key int, date_value date, day_of_month int, day_of_week int, week_of_year int, month int, month_name string, quarter int, "
    "year int, is_weekend boolean", ("date_key",),
)
DIM_TIME = Table("gold", "dim_time", "time_key int, time_value string, hour int, work_shift string", ("time_key",))
DIM_LOCATION = Table("gold", "dim_location", "location_key string, location_name string, latitude double, longitude double, timezone string", ("location_key",))
DIM_POLLUTANT = Table("gold", "dim_pollutant", "pollutant_code string, display_name string, unit_default string, aqi_timespan string", ("pollutant_code",))
#: A location's day: its first and last known hour, whether these are flagged, and its runs of flagged hours.
DAY_RUNS = Table(
    "ops", "day_runs", "location_key string, date_utc date, first_ts timestamp, last_ts timestamp, first_flag boolean, last_flag boolean, "
    "runs array<struct<start_ts: timestamp, end_ts: timestamp, peak_aqi: int, hours_flagged: bigint, dominant_pollutant: string>>", ("location_key", "date_utc"), ("date_utc",), "date_utc",
)
#: Rows that broke rules of a gate, as JSON.
QUARANTINE = Table("ops", "quarantine", "source string, broken array<string>, row string, at timestamp", ("source", "row", "at"))
RUNS = Table("ops", "runs", "run_id string, kind string, name string, value string, at timestamp", ("run_id", "kind", "name"))

DIMENSIONS = (DIM_DATE, DIM_TIME, DIM_LOCATION, DIM_POLLUTANT)
FACTS = (HOURLY, DAILY, EPISODES)
ALL = (READINGS, CLEAN, *DIMENSIONS, *FACTS, DAY_RUNS, QUARANTINE, RUNS)
