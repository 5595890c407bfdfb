"""All queries of the time-series engine with their DuckDB SQL, over tables derived from ``events``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger import schemas
from skyledger.functions import calendar, measures
from skyledger.operators import checks, facts, forecast, reports, tables
from skyledger.plans import fixtures as fx
from skyledger.plans import pipeline
from skyledger.sources import files
from skyledger.sources.store import Store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
NOW = dt.datetime(2024, 1, 25)
KEYS = list(facts.HOUR_ID)


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of (spark, sf_dir) under its name; ``sql`` follows the common tables of ``fixtures.SQL``."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE_SQL[name or f.__name__] = fx.SQL + sql
        return f

    return add


C = ["location_key", "ts_utc", "aqi"]


@query("SELECT location_key, ts_utc, aqi, pm25, date_key FROM clean")
def scan_clean(s, d):
    return fx.clean(s, d).select("location_key", "ts_utc", "aqi", "pm25", "date_key")


@query("SELECT location_key, ts_utc, CAST(aqi AS BIGINT) AS aqi, CAST(NULL AS VARCHAR) AS note FROM clean")
def conform_clean(s, d):
    from pyspark.sql.types import StructType

    return tables.conform(fx.clean(s, d), StructType.fromDDL("location_key string, ts_utc timestamp, aqi long, note string"))


for _name, _a, _b in (("between", "2024-01-10", "2024-01-12"), ("from", "2024-01-20", None), ("to", None, "2024-01-05")):
    _test = " AND ".join([f"date_utc >= DATE '{_a}'"] * (_a is not None) + [f"date_utc <= DATE '{_b}'"] * (_b is not None))
    _day = lambda x: dt.date.fromisoformat(x) if x else None
    query(f"SELECT location_key, ts_utc, aqi FROM clean WHERE {_test}", f"date_range_{_name}")(
        lambda s, d, a=_day(_a), b=_day(_b): fx.clean(s, d).filter(tables.in_range("date_utc", a, b)).select(*C)
    )


@query("SELECT location_key, ts_utc, aqi FROM clean WHERE ts_utc > TIMESTAMP '2024-01-20 12:00:00'")
def rows_after_watermark(s, d):
    rows = fx.clean(s, d)
    return tables.after_watermark(rows, rows.filter(fx.OLD), day="date_utc").select(*C)


@query("SELECT location_key, ts_utc, aqi, pm25 FROM clean WHERE aqi IS NOT NULL AND pm25 IS NOT NULL AND o3 IS NOT NULL")
def complete_rows(s, d):
    return fx.clean(s, d).dropna(subset=["aqi", "pm25", "o3"]).select(*C, "pm25")


@query("SELECT location_key, ts_utc, aqi FROM clean WHERE ts_utc <= TIMESTAMP '2024-01-25 00:00:00'")
def drop_future(s, d):
    return tables.drop_future(fx.clean(s, d), NOW).select(*C)


@query("SELECT location_key, ts_utc, CASE WHEN aqi >= 151 THEN 1 ELSE 0 END AS flag FROM clean WHERE aqi IS NOT NULL")
def threshold_flag(s, d):
    return facts.runs(fx.clean(s, d), 151).select("location_key", "ts_utc", "flag")


@query("SELECT location_key, ts_utc, aqi FROM clean WHERE date_key BETWEEN 20240110 AND 20240112")
def date_key_range(s, d):
    return fx.clean(s, d).filter(F.col("date_key").between(20240110, 20240112)).select(*C)


@query("SELECT DISTINCT date_utc FROM clean WHERE date_utc NOT IN (SELECT date_utc FROM clean WHERE date_utc <= DATE '2024-01-20')")
def new_dates_anti(s, d):
    days = fx.clean(s, d).select("date_utc").distinct()
    return days.join(days.filter("date_utc <= DATE '2024-01-20'"), "date_utc", "left_anti")


_MERGE = """, tgt AS (SELECT location_key, ts_utc, date_utc, aqi FROM clean WHERE date_utc <= DATE '2024-01-20'),
src AS (SELECT location_key, ts_utc, date_utc, aqi + 1 AS aqi FROM clean WHERE date_utc >= DATE '2024-01-18') """


@query(_MERGE + "SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE (location_key, ts_utc) NOT IN (SELECT (location_key, ts_utc) FROM src)")
def upsert(s, d):
    return tables.upsert(*fx.merge_inputs(s, d), KEYS)


@query(_MERGE + "SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE (location_key, ts_utc) NOT IN (SELECT (location_key, ts_utc) FROM tgt)")
def insert_only_merge(s, d):
    return tables.insert_only(*fx.merge_inputs(s, d), KEYS)


@query(_MERGE + "SELECT * FROM tgt WHERE NOT (location_key = 'click' AND date_utc >= DATE '2024-01-18') UNION ALL SELECT * FROM src WHERE location_key = 'click'")
def replace_range(s, d):
    target, source = fx.merge_inputs(s, d)
    click = F.col("location_key") == "click"
    return tables.replace_range(target, source.filter(click), click & tables.in_range("date_utc", dt.date(2024, 1, 18)))


@query("SELECT location_key, ts_utc, aqi FROM clean WHERE NOT (date_utc BETWEEN DATE '2024-01-10' AND DATE '2024-01-12')")
def delete_date_range(s, d):
    return tables.delete_where(fx.clean(s, d), tables.in_range("date_utc", dt.date(2024, 1, 10), dt.date(2024, 1, 12))).select(*C)


@query("SELECT CAST(date_part('hour', ts_utc) AS INT) AS hour_no, count(*) AS n, CAST(sum(aqi) AS BIGINT) AS total FROM hourly GROUP BY 1", "hours_by_clock")
def hours_by_clock(s, d):
    return fx.hourly(s, d).groupBy(F.hour("ts_utc").alias("hour_no")).agg(F.count("*").alias("n"), F.sum("aqi").alias("total"))


_SHIFT = "CASE WHEN hour(ts_utc) < 6 THEN 'night' WHEN hour(ts_utc) < 12 THEN 'morning' WHEN hour(ts_utc) < 18 THEN 'afternoon' ELSE 'evening' END"


@query(f"SELECT {_SHIFT} AS work_shift, isodow(date_utc) IN (6, 7) AS is_weekend, count(*) AS hours, CAST(sum(aqi) AS BIGINT) AS total FROM hourly GROUP BY 1, 2")
def star_join_hours_by_shift(s, d):
    joined = facts.star(fx.hourly(s, d).select("time_key", "date_key", "aqi"), calendar.dim_date(fx.clean(s, d)), calendar.dim_time(s))
    return joined.groupBy("work_shift", "is_weekend").agg(F.count("*").alias("hours"), F.sum("aqi").alias("total"))


@query("SELECT n_name, count(*) AS orders, CAST(sum(floor(o_totalprice)) AS BIGINT) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def star_orders_nation(s, d):
    orders, customer = fx.table(s, d, "orders").select("o_custkey", "o_totalprice"), fx.table(s, d, "customer").select("c_custkey", "c_nationkey")
    nation = fx.table(s, d, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.count("*").alias("orders"), F.sum(F.floor("o_totalprice")).alias("total"))
    return joined.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "orders", F.col("total").cast("long"))


_BANDS = ", ".join(
    f"CAST(count(*) FILTER (WHERE aqi {'>= %d' % a if b is None else 'BETWEEN %d AND %d' % (a, b)}) AS BIGINT) AS {n}_hours" for n, (a, b) in measures.BANDS.items()
)
_DAILY = f""", daily AS (SELECT location_key, date_utc, date_key, max(aqi) AS aqi_daily_max,
  arg_min(dominant_pollutant, ts_utc) FILTER (WHERE dominant_pollutant IS NOT NULL) AS dominant_pollutant_daily,
  count(aqi) AS hours_measured, {_BANDS}, CAST(count(aqi) AS DOUBLE) / 24 * 100 AS data_completeness
  FROM hourly GROUP BY location_key, date_utc, date_key) """
_ROUNDED = "SELECT * REPLACE (round(data_completeness, 9) AS data_completeness) FROM daily"


def _rounded(df):
    return df.withColumn("data_completeness", F.round("data_completeness", 9))


@query(_DAILY + _ROUNDED)
def daily_fact(s, d):
    return _rounded(facts.daily(fx.hourly(s, d)))


def _built(s, *parts, mode="insert"):
    """The layers, written from readings that arrive in ``parts``; all but the first are built incrementally."""
    store = Store(s, files.scratch(s, "layers"))
    for part in parts:
        report = pipeline.run_pipeline(store, arrived=lambda p=part: pipeline.land_rows(store, p, mode)).filter("status = 'failed'").collect()
        if report:
            raise RuntimeError(str(report))
    return store


def _landed(s, d):
    rows = fx.readings(s, d).withColumn("_ingested_at", F.col("ingested_at"))
    return tables.latest(rows, KEYS, [F.desc("ingested_at"), F.desc("event_id")])


def _layers(s, d):
    rows, old = _landed(s, d), F.expr(fx.OLD)
    return _built(s, rows.filter(old), rows.filter(~old))


def _daily(store):
    daily = store.read(schemas.DAILY).withColumnsRenamed({f"hours_in_cat_{b}": f"{b}_hours" for b in measures.BANDS})
    return _rounded(daily.drop("daily_record_id")).withColumns({c: F.col(c).cast("long") for c in ("hours_measured", *(f"{b}_hours" for b in measures.BANDS))})


@query(_DAILY + _ROUNDED)
def pipeline_daily_from_raw(s, d):
    return _daily(_layers(s, d))


@query(_DAILY + _ROUNDED)
def pipeline_late_rows(s, d):
    """First all but one location and one week, with wrong values on some days; then what was left out and what is right."""
    rows = _landed(s, d)
    late = (F.col("location_key") == "click") | F.col("date_utc").between("2024-01-08", "2024-01-14")
    wrong = F.dayofmonth("date_utc") % 5 == 0
    early = rows.filter(~late).withColumn("aqi", F.when(wrong, F.col("aqi") + 100).otherwise(F.col("aqi")))
    return _daily(_built(s, early, rows.filter(late | wrong), mode="upsert"))


@query("SELECT location_key, date_utc, arg_min(dominant_pollutant, struct_pack(a := -coalesce(aqi, -1), t := ts_utc)) FILTER (WHERE dominant_pollutant IS NOT NULL) AS dominant_pollutant_daily FROM hourly GROUP BY ALL")
def daily_dominant_by_max(s, d):
    return facts.daily(fx.hourly(s, d), "max").select("location_key", "date_utc", "dominant_pollutant_daily")


@query(f"SELECT location_key, {_BANDS} FROM hourly GROUP BY location_key")
def category_hours(s, d):
    return fx.hourly(s, d).groupBy("location_key").agg(*[F.count_if(measures.in_band(F.col("aqi"), b)).alias(f"{b}_hours") for b in measures.BANDS])


@query("SELECT location_key, max(ts_utc) AS latest FROM clean GROUP BY location_key")
def latest_per_key(s, d):
    return reports.latest_per_key(fx.clean(s, d))


@query("SELECT TIMESTAMP '2024-01-20 12:00:00' AS watermark, min(date_utc) AS min_date, max(date_utc) AS max_date, count(*) AS new_rows FROM clean WHERE ts_utc > (SELECT max(ts_utc) FROM clean WHERE ts_utc <= TIMESTAMP '2024-01-20 12:00:00')")
def new_data_range(s, d):
    rows = fx.clean(s, d)
    return tables.new_data(rows, rows.filter(fx.OLD))


@query("SELECT 'readings' AS layer, count(*) AS n FROM readings UNION ALL SELECT 'clean', count(*) FROM clean UNION ALL SELECT 'hourly', count(*) FROM hourly")
def row_counts(s, d):
    return reports.row_counts({"readings": fx.readings(s, d), "clean": fx.clean(s, d), "hourly": fx.hourly(s, d)})


@query(_DAILY + "SELECT 'hourly' AS fact, count(*) AS n FROM hourly UNION ALL SELECT 'daily', count(*) FROM daily")
def fact_counts_union(s, d):
    hours = fx.hourly(s, d)
    return reports.row_counts({"hourly": hours, "daily": facts.daily(hours)}, "fact")


@query("SELECT DISTINCT date_utc FROM clean")
def distinct_dates(s, d):
    return fx.clean(s, d).select("date_utc").distinct()


@query("SELECT date_utc, count(*) AS n FROM clean GROUP BY date_utc")
def rows_per_date(s, d):
    return reports.rows_per_date(fx.clean(s, d))


@query("SELECT date_utc, count(*) AS n FROM clean GROUP BY date_utc ORDER BY date_utc DESC LIMIT 10")
def recent_dates(s, d):
    return reports.first_rows(rows_per_date(s, d), [F.desc("date_utc")])


@query("SELECT location_key, count(*) AS n, count(DISTINCT ts_utc) AS n_hours FROM readings GROUP BY location_key")
def dedup_check(s, d):
    return reports.key_counts(fx.readings(s, d), "location_key", "ts_utc", "n_hours")


@query("SELECT CAST(floor(aqi / 50.0 + 0.5) * 50 AS BIGINT) AS bucket, count(*) AS n FROM clean WHERE aqi IS NOT NULL GROUP BY 1")
def aqi_histogram(s, d):
    return reports.histogram(fx.clean(s, d), F.col("aqi"), 50)


@query("SELECT location_key, min(ts_utc) AS first_ts, max(ts_utc) AS last_ts, count(ts_utc) AS n FROM clean GROUP BY location_key")
def coverage(s, d):
    return reports.coverage(fx.clean(s, d), "location_key")


_STATUS = """, pairs AS (
  SELECT 'readings to clean' AS name, (SELECT count(*) FROM readings) AS source_rows, (SELECT count(*) FROM clean WHERE OLD) AS target_rows,
    (SELECT max(ts_utc) FROM readings) AS source_latest, (SELECT max(ts_utc) FROM clean WHERE OLD) AS target_latest,
    (SELECT count(*) FROM readings WHERE ts_utc > (SELECT max(ts_utc) FROM clean WHERE OLD)) AS pending
  UNION ALL SELECT 'clean to hourly', (SELECT count(*) FROM clean), (SELECT count(*) FROM hourly), (SELECT max(ts_utc) FROM clean), (SELECT max(ts_utc) FROM hourly), 0),
  rated AS (SELECT * FROM pairs UNION ALL SELECT 'total', sum(source_rows), sum(target_rows), max(source_latest), max(target_latest), sum(pending) FROM pairs)
  SELECT name, CAST(source_rows AS BIGINT) AS source_rows, CAST(target_rows AS BIGINT) AS target_rows, source_latest, target_latest, CAST(pending AS BIGINT) AS pending,
    round(100.0 * (source_rows - pending) / source_rows, 6) AS savings,
    CASE WHEN 100.0 * (source_rows - pending) / source_rows >= 90 THEN 'excellent' WHEN 100.0 * (source_rows - pending) / source_rows >= 70 THEN 'good'
      WHEN 100.0 * (source_rows - pending) / source_rows >= 50 THEN 'fair' ELSE 'poor' END AS rating FROM rated""".replace("OLD", fx.OLD)


@query(_STATUS)
def layer_status(s, d):
    rows = fx.clean(s, d)
    first = reports.layer_status(fx.readings(s, d), rows.filter(fx.OLD), "readings to clean")
    return reports.status_total([first, reports.layer_status(rows, fx.hourly(s, d), "clean to hourly")])


@query("SELECT event_id, location_key, ts_utc FROM clean")
def dedup_latest(s, d):
    return tables.latest(fx.readings(s, d), KEYS, [F.desc("ingested_at"), F.desc("event_id")]).select("event_id", *KEYS)


@query("SELECT min(event_id) AS event_id, location_key, ts_utc FROM readings GROUP BY location_key, ts_utc")
def dedup_first(s, d):
    return tables.latest(fx.readings(s, d), KEYS, [F.asc("event_id")]).select("event_id", *KEYS)


def _runs(threshold: int, gap: bool = False) -> str:
    more = " OR date_diff('hour', lag(ts_utc) OVER w, ts_utc) > 1" if gap else ""
    return f""", flagged AS (SELECT *, CASE WHEN aqi >= {threshold} THEN 1 ELSE 0 END AS flag FROM hourly WHERE aqi IS NOT NULL),
  started AS (SELECT *, CASE WHEN flag = 1 AND (coalesce(lag(flag) OVER w, 0) = 0{more}) THEN 1 ELSE 0 END AS run_start FROM flagged
    WINDOW w AS (PARTITION BY location_key ORDER BY ts_utc)),
  runs AS (SELECT *, CAST(sum(run_start) OVER (PARTITION BY location_key ORDER BY ts_utc ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id FROM started) """


def _episodes(threshold: int, hours: int, gap: bool = False) -> str:
    return _runs(threshold, gap) + f""", episodes AS (SELECT location_key, min(ts_utc) AS start_ts, max(ts_utc) AS end_ts, min(date_utc) AS start_date, max(aqi) AS peak_aqi,
  count(*) AS hours_flagged, arg_min(dominant_pollutant, ts_utc) FILTER (WHERE dominant_pollutant IS NOT NULL) AS dominant_pollutant,
  date_diff('hour', min(ts_utc), max(ts_utc)) + 1 AS duration_hours, 'AQI>={threshold}_{hours}h' AS rule_code
  FROM runs WHERE flag = 1 GROUP BY location_key, run_id HAVING date_diff('hour', min(ts_utc), max(ts_utc)) + 1 >= {hours}) """


@query(_runs(151) + "SELECT location_key, ts_utc, run_start FROM runs")
def run_starts(s, d):
    return facts.runs(fx.hourly(s, d), 151).select("location_key", "ts_utc", "run_start")


@query(_runs(151) + "SELECT location_key, ts_utc, run_id FROM runs")
def run_ids(s, d):
    return facts.runs(fx.hourly(s, d), 151).select("location_key", "ts_utc", "run_id")


for _name, _args in {"episodes_151_4h": (151, 4, False), "episodes_101_3h": (101, 3, False), "episodes_strict_101_3h": (101, 3, True)}.items():
    query(_episodes(*_args) + "SELECT * FROM episodes", _name)(lambda s, d, a=_args: facts.episodes(fx.hourly(s, d), *a))


@query(_episodes(151, 4) + "SELECT * FROM episodes")
def pipeline_episodes_from_raw(s, d):
    found = _layers(s, d).read(schemas.EPISODES).withColumnsRenamed({"start_ts_utc": "start_ts", "end_ts_utc": "end_ts", "start_date_utc": "start_date"})
    return found.drop("episode_id").withColumns({c: F.col(c).cast("long") for c in ("duration_hours", "hours_flagged")})


_FROM, _TO = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
_DAYS = "BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"


@query(_DAILY + _episodes(101, 3) + " ".join(f"SELECT '{n}' AS layer, count(*) AS n FROM {n} WHERE date_utc {_DAYS} UNION ALL" for n in ("readings", "clean", "hourly"))
       + f" SELECT 'daily', count(*) FROM daily WHERE date_key BETWEEN 20240110 AND 20240112 UNION ALL SELECT 'episodes', count(*) FROM episodes WHERE start_date {_DAYS} OR CAST(end_ts AS DATE) {_DAYS}")
def range_counts(s, d):
    hours = fx.hourly(s, d)
    layers = {n: df.filter(tables.in_range("date_utc", _FROM, _TO)) for n, df in (("readings", fx.readings(s, d)), ("clean", fx.clean(s, d)), ("hourly", hours))}
    layers["daily"] = facts.daily(hours).filter(tables.in_range("date_key", 20240110, 20240112))
    layers["episodes"] = facts.episodes(hours, 101, 3).filter(facts.episodes_touching(_FROM, _TO))
    return reports.row_counts(layers)


@query(_episodes(101, 3) + "SELECT * FROM episodes ORDER BY peak_aqi DESC, start_ts, location_key LIMIT 10")
def top_episodes(s, d):
    return reports.first_rows(facts.episodes(fx.hourly(s, d), 101, 3), [F.desc("peak_aqi"), "start_ts", "location_key"])


@query(_episodes(101, 3) + "SELECT * FROM episodes WHERE NOT (start_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' OR CAST(end_ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12')")
def delete_episodes_touching(s, d):
    return tables.delete_where(facts.episodes(fx.hourly(s, d), 101, 3), facts.episodes_touching(_FROM, _TO))


@query(_episodes(101, 3) + "SELECT * FROM episodes WHERE NOT (start_date <= DATE '2024-01-12' AND CAST(end_ts AS DATE) >= DATE '2024-01-10')")
def delete_episodes_overlapping(s, d):
    return tables.delete_where(facts.episodes(fx.hourly(s, d), 101, 3), facts.episodes_touching(_FROM, _TO, overlap=True))


@query("SELECT location_key, ts_utc, lead(pm25, 6) OVER (PARTITION BY location_key ORDER BY ts_utc) AS label FROM clean")
def lead_label(s, d):
    return forecast.lead_label(fx.clean(s, d), "pm25", 6).select("location_key", "ts_utc", "label")


@query("SELECT a.location_key, a.ts_utc, b.pm25 AS label FROM clean a LEFT JOIN clean b ON a.location_key = b.location_key AND b.ts_utc = a.ts_utc + INTERVAL 6 HOUR")
def lead_label_clock(s, d):
    return forecast.lead_label(fx.clean(s, d), "pm25", 6, clock=True).select("location_key", "ts_utc", "label")


@query("SELECT location_key, ts_utc, percent_rank() OVER (PARTITION BY location_key ORDER BY ts_utc) <= 0.8 AS is_train FROM clean")
def chronological_split(s, d):
    return forecast.with_rank(fx.clean(s, d)).select("location_key", "ts_utc", (F.col("rank_pct") <= 0.8).alias("is_train"))


@query("SELECT location_key, ts_utc, aqi FROM clean ORDER BY ts_utc DESC, location_key LIMIT 10")
def latest_n(s, d):
    return reports.first_rows(fx.clean(s, d), [F.desc("ts_utc"), "location_key"]).select(*C)


@query()
def sample_to_size(s, d):
    return forecast.sample_to_size(fx.clean(s, d), 500).select(*C)


@query("SELECT location_key, ts_utc, date_key, time_key FROM clean")
def date_time_keys(s, d):
    return fx.clean(s, d).select("location_key", "ts_utc", "date_key", "time_key")


@query("""SELECT DISTINCT date_key, date_utc AS date_value, CAST(day(date_utc) AS INT) AS day_of_month, CAST(isodow(date_utc) AS INT) AS day_of_week, CAST(weekofyear(date_utc) AS INT) AS week_of_year,
  CAST(month(date_utc) AS INT) AS month, monthname(date_utc) AS month_name, CAST(quarter(date_utc) AS INT) AS quarter, CAST(year(date_utc) AS INT) AS year, isodow(date_utc) IN (6, 7) AS is_weekend FROM clean""")
def dim_date(s, d):
    return calendar.dim_date(fx.clean(s, d))


@query(f"SELECT {_SHIFT} AS work_shift, count(*) AS n, count(DISTINCT time_key) AS n_hours FROM clean GROUP BY 1")
def dim_time(s, d):
    joined = fx.clean(s, d).select("time_key").join(F.broadcast(calendar.dim_time(s)), "time_key")
    return joined.groupBy("work_shift").agg(F.count("*").alias("n"), F.count_distinct("time_key").alias("n_hours"))


@query("SELECT location_key, ts_utc, dominant_pollutant FROM hourly")
def dominant_pollutant(s, d):
    return fx.hourly(s, d).select("location_key", "ts_utc", "dominant_pollutant")


@query("SELECT location_key, ts_utc, data_completeness FROM hourly")
def data_completeness(s, d):
    return fx.hourly(s, d).select("location_key", "ts_utc", "data_completeness")


@query("SELECT location_key, ts_utc, md5(concat_ws('#', location_key, strftime(ts_utc, '%Y%m%d%H'))) AS id FROM clean")
def stable_id(s, d):
    return fx.clean(s, d).select("location_key", "ts_utc", measures.stable_id(F.col("location_key"), F.date_format("ts_utc", "yyyyMMddHH")).alias("id"))


_CYCLE = """round(sin(2 * pi() * hour(ts_utc) / 24), 9) + 0 AS hour_sin, round(cos(2 * pi() * hour(ts_utc) / 24), 9) + 0 AS hour_cos,
  round(sin(2 * pi() * dayofweek(ts_utc) / 7), 9) + 0 AS dow_sin, round(cos(2 * pi() * dayofweek(ts_utc) / 7), 9) + 0 AS dow_cos"""


def _nine(df, *names):
    return df.withColumns({n: F.round(n, 9) + F.lit(0.0) for n in names})


@query(f"SELECT location_key, ts_utc, {_CYCLE} FROM clean")
def cyclic_features(s, d):
    cols = calendar.cyclic(F.col("ts_utc"))
    return _nine(fx.clean(s, d).select("location_key", "ts_utc", *[c.alias(n) for n, c in cols.items()]), *cols)


@query("SELECT location_key, CAST(c AS DATE) AS chunk_start, least(CAST(c AS DATE) + 6, b) AS chunk_end FROM (SELECT location_key, b, unnest(generate_series(a, b, INTERVAL 7 DAY)) AS c FROM (SELECT location_key, min(date_utc) AS a, max(date_utc) AS b FROM clean GROUP BY 1) x) y")
def date_chunks(s, d):
    return calendar.date_chunks(fx.clean(s, d).groupBy("location_key").agg(F.min("date_utc").alias("start"), F.max("date_utc").alias("end")), 7)


@query("""SELECT location_key, t AS ts_utc, CAST(t AS DATE) AS date_utc, v AS value FROM (SELECT location_key, unnest(ts) AS t, unnest(vs) AS v
  FROM (SELECT location_key, list(ts_utc + INTERVAL 0 HOUR ORDER BY ts_utc) AS ts, list(pm25 ORDER BY ts_utc) AS vs FROM
  (SELECT location_key, date_utc + INTERVAL (h) HOUR AS ts_utc, pm25 FROM (SELECT DISTINCT location_key, date_utc FROM clean) k CROSS JOIN range(24) r(h)
   LEFT JOIN (SELECT location_key AS lk, ts_utc AS tu, pm25 FROM clean) c ON lk = location_key AND tu = date_utc + INTERVAL (h) HOUR) x GROUP BY location_key) y) z""")
def explode_payload(s, d):
    days = fx.clean(s, d).groupBy("location_key", "date_utc").agg(F.map_from_entries(F.collect_list(F.struct(F.hour("ts_utc"), F.coalesce("pm25", F.lit(float("nan")))))).alias("m"))  # at most 24
    start = F.col("date_utc").cast("timestamp")
    payload = days.select("location_key", start.alias("start"), (start + F.expr("interval 24 hours")).alias("end"), F.lit(3600).cast("long").alias("interval_seconds"),
                          F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.try_element_at("m", h)).alias("value"))
    return files.explode_payload(payload, ["value"])


_LABELLED = ", labelled AS (SELECT *, lead(pm25, 6) OVER (PARTITION BY location_key ORDER BY ts_utc) AS label FROM clean WHERE pm25 IS NOT NULL), scored2 AS (SELECT location_key, ts_utc, pm25 AS prediction, label FROM labelled WHERE label IS NOT NULL) "
_METRICS = """count(*) AS n, round(sqrt(avg((label - prediction) * (label - prediction))), 6) AS rmse, round(avg(abs(label - prediction)), 6) AS mae,
  round(1 - sum((label - prediction) * (label - prediction)) / nullif(sum(label * label) - sum(label) * sum(label) / count(label), 0), 6) AS r2,
  round(avg(CASE WHEN label <> 0 THEN abs(label - prediction) / abs(label) END) * 100, 6) AS mape FROM scored2"""


def _naive(s, d):
    rows = forecast.lead_label(fx.clean(s, d).dropna(subset=["pm25"]), "pm25", 6).filter("label is not null")
    return rows.select("location_key", "ts_utc", F.col("pm25").alias("prediction"), "label")


@query(_LABELLED + "SELECT " + _METRICS)
def regression_metrics(s, d):
    return forecast.metrics(_naive(s, d))


@query(_LABELLED + "SELECT location_key, " + _METRICS + " GROUP BY location_key")
def regression_metrics_by_key(s, d):
    return forecast.metrics(_naive(s, d), "location_key")


@query(_LABELLED + "SELECT location_key, ts_utc, round(prediction - label, 6) AS residual FROM scored2")
def residuals(s, d):
    return forecast.residuals(_naive(s, d)).select("location_key", "ts_utc", F.round("residual", 6).alias("residual"))


@query(_LABELLED + "SELECT CAST(floor((prediction - label) / 20) AS BIGINT) AS bin, count(*) AS n FROM scored2 GROUP BY 1")
def residual_histogram(s, d):
    return reports.bins(forecast.residuals(_naive(s, d)), F.col("residual"), 20)


@query(_LABELLED + "SELECT location_key, ts_utc, label AS actual, prediction AS predicted FROM scored2")
def actual_vs_predicted(s, d):
    return forecast.series(_naive(s, d))


_BASE = [f for f in forecast.FEATURES if not f.endswith(("_sin", "_cos"))]


@query(_LABELLED + f"SELECT location_key, ts_utc, label, {_CYCLE} FROM labelled WHERE label IS NOT NULL AND " + " AND ".join(f"{f} IS NOT NULL" for f in _BASE))
def supervised_dataset(s, d):
    cols = list(calendar.cyclic(F.col("ts_utc")))
    return _nine(forecast.supervised(fx.clean(s, d)).select("location_key", "ts_utc", "label", *cols), *cols)


@query("SELECT location_key, ts_utc, round((pm25 - (SELECT avg(pm25) FROM clean)) / (SELECT stddev_samp(pm25) FROM clean), 6) + 0 AS z FROM clean WHERE pm25 IS NOT NULL")
def standardize(s, d):
    rows = fx.clean(s, d).filter("pm25 is not null")
    stats = rows.agg(F.avg("pm25").alias("_m"), F.stddev_samp("pm25").alias("_s"))
    return rows.join(F.broadcast(stats)).select("location_key", "ts_utc", (F.round((F.col("pm25") - F.col("_m")) / F.col("_s"), 6) + F.lit(0.0)).alias("z"))


@query()
def forecast_predictions(s, d):
    train, test = forecast.chronological_split(forecast.supervised(fx.clean(s, d)))
    return forecast.fit(train).transform(test).select("location_key", "ts_utc", "label", "prediction")


def _check(name: str, value: str, passed: str, rest: str) -> str:
    return f"SELECT '{name}' AS \"check\", {passed} AS passed, value FROM (SELECT CAST({value} AS DOUBLE) AS value {rest}) x"


@query(_check("duplicates", "count(*)", "value = 0", "FROM (SELECT 1 FROM readings GROUP BY location_key, ts_utc HAVING count(*) > 1) g"))
def dq_duplicates(s, d):
    return checks.duplicates(fx.readings(s, d), KEYS)


@query(_check("nulls", "count(*) FILTER (WHERE location_key IS NULL OR ts_utc IS NULL OR aqi IS NULL)", "value = 0", "FROM clean"))
def dq_nulls(s, d):
    return checks.nulls(fx.clean(s, d), [*KEYS, "aqi"])


@query(_check("range", "count(*) FILTER (WHERE NOT (aqi BETWEEN 0 AND 500))", "value = 0", "FROM clean"))
def dq_range(s, d):
    return checks.value_range(fx.clean(s, d), "aqi", 0, 500)


@query(_check("freshness", "date_diff('hour', max(ts_utc), TIMESTAMP '2024-01-25 00:00:00')", "value < 2", "FROM clean"))
def dq_freshness(s, d):
    return checks.freshness(fx.clean(s, d), NOW, 2)


@query(_check("retention", "CAST((SELECT count(*) FROM clean) AS DOUBLE) / (SELECT count(*) FROM readings)", "value >= 0.9", ""))
def dq_retention(s, d):
    return checks.retention(fx.readings(s, d), fx.clean(s, d), 0.9)


@query(_check("referential", "count(*)", "value = 0", "FROM hourly WHERE date_key NOT IN (SELECT date_key FROM clean WHERE date_utc <= DATE '2024-01-20')"))
def dq_referential(s, d):
    return checks.referential(fx.hourly(s, d), calendar.dim_date(fx.clean(s, d).filter("date_utc <= DATE '2024-01-20'")), "date_key")


_SUM = " + ".join(f"{b}_hours" for b in measures.BANDS)


@query(_DAILY + _check("fact_rules", f"count(*) FILTER (WHERE hours_measured > 24 OR NOT (data_completeness BETWEEN 0 AND 100) OR {_SUM} > hours_measured)", "value = 0", "FROM daily"))
def dq_fact_rules(s, d):
    return checks.fact_rules(facts.daily(fx.hourly(s, d)), [f"{b}_hours" for b in measures.BANDS])


#: Columns of ``events`` as they are stored, and with one of another type and one out of place.
_STORED = {"schema stored": "event_id long, ts timestamp, user_id long, event_type string, value double, props string", "schema other": "event_id long, ts timestamp, user_id int, value double, event_type string, props string"}
_SQL_TYPES = {"long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp": "TIMESTAMP"}


def _stored_sql(name, ddl):
    columns = ", ".join(f"({i}, '{c}', '{_SQL_TYPES[t]}')" for i, (c, t) in enumerate(f.split() for f in ddl.split(", ")))
    return f"""SELECT '{name}' AS "check", count(*) = 0 AS passed, CAST(count(*) AS DOUBLE) AS value FROM (
      SELECT row_number() OVER () - 1 AS i, column_name, column_type FROM (DESCRIBE SELECT * FROM events)) f
      FULL JOIN (VALUES {columns}) w(i, name, type) ON f.i = w.i WHERE column_name IS DISTINCT FROM name OR replace(column_type, ' WITH TIME ZONE', '') IS DISTINCT FROM type"""


@query(" UNION ALL ".join(f"({_stored_sql(*x)})" for x in _STORED.items()))
def dq_schema(s, d):
    events = fx.table(s, d, "events")
    events = events.withColumn("ts", F.col("ts").cast("timestamp")).select(*events.columns)
    return reports.union([checks.schema_matches(events, StructType.fromDDL(ddl), name) for name, ddl in _STORED.items()])


_GATED = f"""SELECT "check", passed, value FROM (
  SELECT unnest([{{'check': 'duplicates', 'passed': d = 0, 'value': CAST(d AS DOUBLE)}}, {{'check': 'known', 'passed': k = 0, 'value': k}}, {{'check': 'in range', 'passed': r <= 0.5 * n, 'value': r}},
    {{'check': 'referential date_key', 'passed': f <= 0.5 * n, 'value': f}}, {{'check': 'freshness', 'passed': h < 2, 'value': h}}, {{'check': 'retention', 'passed': n / m >= 0.9, 'value': n / m}}], recursive := true)
  FROM (SELECT count(*) AS n, (SELECT count(*) FROM readings) AS m, (SELECT count(*) FROM (SELECT 1 FROM clean GROUP BY location_key, ts_utc HAVING count(*) > 1) g) AS d,
    count(*) FILTER (WHERE location_key IS NULL OR ts_utc IS NULL) AS k, count(*) FILTER (WHERE aqi IS NULL OR aqi NOT BETWEEN 0 AND 150) AS r,
    count(*) FILTER (WHERE date_utc > DATE '2024-01-20') AS f, date_diff('hour', max(ts_utc), TIMESTAMP '2024-01-25 00:00:00') AS h FROM clean) x)"""


@query(_GATED)
def dq_gate(s, d):
    """All checks in one scan."""
    rows = fx.clean(s, d)
    gate = checks.Gate({"known": F.col("location_key").isNotNull() & F.col("ts_utc").isNotNull(), "in range": F.col("aqi").between(0, 150)}, now=NOW, max_hours=2, least=0.9,
                       dims={"date_key": calendar.dim_date(rows.filter("date_utc <= DATE '2024-01-20'"))}, tolerated=0.5)
    return gate.report(gate.flagged(rows), fx.readings(s, d).count())


@query(""", hashed AS (
  SELECT *, CAST('0x' || md5('42#' || location_key || '#' || strftime(date_trunc('week', ts_utc), '%Y-%m-%d %H'))[1:15] AS BIGINT) AS h FROM clean),
summed AS (SELECT h, sum(count(*)) OVER (ORDER BY h) AS n FROM hashed GROUP BY h),
stop AS (SELECT arg_min(h, (abs(n - (SELECT count(*) // 3 FROM clean)), h)) AS h FROM summed)
SELECT location_key, ts_utc FROM hashed WHERE h <= (SELECT h FROM stop)""")
def block_sample(s, d):
    """A third of the rows, in whole location weeks."""
    rows = fx.clean(s, d)
    return forecast.sample_blocks(rows, rows.count() // 3).select("location_key", "ts_utc")


@query("SELECT location_key, max(ts_utc) FILTER (WHERE old) AS watermark, min(date_utc) FILTER (WHERE NOT old) AS min_date, max(date_utc) FILTER (WHERE NOT old) AS max_date, count(*) FILTER (WHERE NOT old) AS new_rows "
       "FROM (SELECT *, ts_utc <= TIMESTAMP '2024-01-20 12:00:00' AS old FROM clean) x GROUP BY location_key HAVING count(*) FILTER (WHERE NOT old) > 0")  # fmt: skip
def new_data_by_key(s, d):
    rows = fx.clean(s, d)
    return tables.new_data_by_key(rows, rows.filter(fx.OLD), ["location_key"])


_DELETED = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS before, count(*) AS deleted, CAST(0 AS BIGINT) AS after FROM {source} WHERE {test}"
    for name, source, test in (("readings", "clean", f"date_utc {_DAYS}"), ("clean", "clean", f"date_utc {_DAYS}"), ("hourly", "hourly", f"date_utc {_DAYS}"),
                               ("daily", "daily", "date_key BETWEEN 20240110 AND 20240112"), ("episodes", "episodes", f"start_date {_DAYS} OR CAST(end_ts AS DATE) {_DAYS}"))
)


@query(_DAILY + _episodes(151, 4) + _DELETED)
def layers_delete_range(s, d):
    return pipeline.delete_range(_layers(s, d), _FROM, _TO)


@query("""SELECT name, n AS source_rows, m AS target_rows, last AS source_latest, mark AS target_latest, CAST(0 AS BIGINT) AS pending, CAST(100 AS DOUBLE) AS savings, 'excellent' AS rating FROM (
  SELECT 'readings to clean' AS name, count(*) AS n, count(*) AS m, max(ts_utc) AS last, max(ts_utc) AS mark FROM clean
  UNION ALL SELECT 'clean to hourly', count(*), count(*), max(ts_utc), max(ts_utc) FROM clean
  UNION ALL SELECT 'hourly to daily', count(*), count(DISTINCT (location_key, date_utc)), CAST(max(date_utc) AS TIMESTAMP), CAST(max(date_utc) AS TIMESTAMP) FROM clean
  UNION ALL SELECT 'total', 3 * count(*), 2 * count(*) + count(DISTINCT (location_key, date_utc)), max(ts_utc), max(ts_utc) FROM clean) x""")
def layers_status(s, d):
    return pipeline.status(_layers(s, d))
