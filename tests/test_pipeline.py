import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions import measures
from skyledger.operators import checks, facts, forecast, reports, tables
from skyledger.plans import fixtures, pipeline
from skyledger.sources import files
from skyledger.sources.store import Store

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 2, 1)
DAY = dt.date(2024, 1, 10)


def _rows(store, table):
    return sorted(map(str, (tuple(r) for r in store.read(table).collect())))


@pytest.fixture(scope="module")
def readings(spark):
    rows = fixtures.readings(spark, SF).withColumn("_ingested_at", F.col("ingested_at"))
    return tables.conform(tables.latest(rows, ["location_key", "ts_utc"], [F.desc("event_id")]), schemas.READINGS.schema).cache()


@pytest.fixture(scope="module")
def full(spark, readings, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("full")))
    report = pipeline.run_pipeline(store, arrived=lambda: pipeline.land_rows(store, readings)).collect()
    assert [(r.stage, r.status) for r in report] == [(s, "done") for s in ("land", "clean", "dim_date", "dim_time", "hourly", "daily", "episodes")]
    return store


def test_incremental_equals_full(spark, readings, full, tmp_path):
    store = Store(spark, str(tmp_path))
    for part in ("ts_utc <= '2024-01-09 07:00:00'", "ts_utc > '2024-01-09 07:00:00' and ts_utc <= '2024-01-20 12:00:00'", "ts_utc > '2024-01-20 12:00:00'"):
        report = pipeline.run_pipeline(store, arrived=lambda p=part: pipeline.land_rows(store, readings.filter(p)))
        assert report.filter("status = 'failed'").collect() == []
    for table in (schemas.CLEAN, *schemas.FACTS, schemas.DIM_DATE, schemas.DIM_TIME):
        assert _rows(store, table) == _rows(full, table), table.name
    again = {r.stage: r.status for r in pipeline.run_pipeline(store, arrived=lambda: pipeline.land_rows(store, readings.filter("false"))).collect()}
    assert again.pop("dim_time") == "done" and set(again.values()) == {"empty"}
    assert _rows(store, schemas.DAILY) == _rows(full, schemas.DAILY)


def test_any_order_of_arrival_equals_full(spark, readings, full, tmp_path):
    """Rows dealt out by location and day; some come wrong first, some days are there and go again."""
    store = Store(spark, str(tmp_path))
    turn = F.pmod(F.xxhash64("location_key", F.dayofmonth("date_utc") % 7), F.lit(3))
    wrong = F.hour("ts_utc") % 5 == 0
    false = readings.filter(turn == 0).withColumns({"aqi": F.when(wrong, F.lit(300)).otherwise(F.col("aqi")), "aqi_o3": F.when(wrong, F.lit(299)).otherwise(F.col("aqi_o3"))})
    extra = readings.filter(turn == 1).withColumns({"location_key": F.lit("nowhere")}).dropDuplicates(["ts_utc"])
    for part in (false.unionByName(extra), readings.filter(turn == 2), readings.filter((turn == 1) | ((turn == 0) & wrong))):
        report = pipeline.run_pipeline(store, arrived=lambda p=part: pipeline.land_rows(store, p, "upsert"))
        assert report.filter("status = 'failed'").collect() == []
    assert store.delete(schemas.READINGS, F.col("location_key") == "nowhere") > 0
    pipeline.run_pipeline(store)
    for table in (schemas.CLEAN, *schemas.FACTS):
        assert _rows(store, table) == _rows(full, table), table.name


def test_delete_and_backfill_restore(spark, readings, full, tmp_path):
    store = Store(spark, str(tmp_path))
    pipeline.land_rows(store, readings)
    pipeline.run_pipeline(store)
    end = DAY + dt.timedelta(days=2)
    counts = {r.layer: r.n for r in pipeline.range_counts(store, DAY, end).collect()}
    dry = pipeline.delete_range(store, DAY, end, dry_run=True).collect()
    assert all(r.deleted == 0 and r.before == r.after == counts[r.table] for r in dry)
    deleted = pipeline.delete_range(store, DAY, end, dimensions=True).collect()
    assert all(r.before == r.deleted and r.after == 0 for r in deleted) and sum(r.deleted for r in deleted) > 0
    assert {r.table: r.before for r in deleted if r.table in counts} == counts
    assert not [*(tmp_path / "silver/clean").glob("date_utc=2024-01-1[012]")]
    pipeline.land_rows(store, readings.filter(tables.in_range("date_utc", DAY, end)))
    pipeline.run_pipeline(store, "backfill", DAY, end)
    for table in (schemas.CLEAN, *schemas.FACTS):
        assert _rows(store, table) == _rows(full, table), table.name


def test_modes_skips_failures(spark, readings, tmp_path):
    store = Store(spark, str(tmp_path))
    report = pipeline.run_pipeline(store, arrived=lambda: 1 / 0).collect()
    assert [r.status for r in report] == ["failed"] + ["skipped"] * 6 and "ZeroDivisionError" in report[0].error
    pipeline.land_rows(store, readings)
    report = pipeline.run_pipeline(store, skip=["hourly", "dim_time"], locations=str(tmp_path / "none.json")).collect()
    by = {r.stage: r.status for r in report}
    assert (by["clean"], by["hourly"], by["dim_time"], by["dim_location"], by["daily"]) == ("done", "skipped", "skipped", "failed", "empty")
    assert {r.stage for r in pipeline.run_pipeline(store, "dims-only").collect()} == {"dim_date", "dim_time"}
    assert [r.stage for r in pipeline.run_gold(store, select=["daily", "hourly"]).collect()] == ["hourly", "daily"]
    with pytest.raises(ValueError, match="no stages"):
        pipeline.run_gold(store, select="weekly")
    with pytest.raises(ValueError, match="no mode"):
        pipeline.run_pipeline(store, "upsert")


def test_landing_modes(spark, tmp_path):
    index, store = ["aqi", *(f"aqi_{n}" for n in measures.SUB_INDICES)], Store(spark, str(tmp_path))
    hour = dt.datetime(2024, 1, 1)
    arrays = ", ".join(f"array(double({{0}}), double('nan'), double({{0}} + 1.5)) as {c}" for c in (*index, *measures.MEASURES))

    def payload(value, key="a b/ü"):
        return spark.sql(f"select '{key}' as location_key, timestamp '2024-01-01 00:00:00' as start, timestamp '2024-01-01 03:00:00' as end, 3600L as interval_seconds, {arrays.format(value)}")

    assert pipeline.land(store, payload(2.5), NOW, hour + dt.timedelta(hours=1)).rows == 2
    assert [(r.aqi, r.pm25) for r in store.read(schemas.READINGS).orderBy("ts_utc").collect()] == [(2, 2.5), (None, None)]
    pipeline.land(store, payload(9), NOW)
    assert [r.aqi for r in store.read(schemas.READINGS).orderBy("ts_utc").collect()] == [2, None, 10]
    pipeline.land(store, payload(7), NOW, mode="upsert")
    assert [r.aqi for r in store.read(schemas.READINGS).orderBy("ts_utc").collect()] == [7, None, 8]
    pipeline.land(store, payload(1, "other"), NOW)
    pipeline.land(store, payload(4), NOW, hour, mode="replace")
    assert [(r.location_key, r.aqi) for r in store.read(schemas.READINGS).orderBy("location_key", "ts_utc").collect()] == [("a b/ü", 4), ("other", 1), ("other", None), ("other", 2)]
    assert store.delete(schemas.READINGS, F.col("location_key") == "a b/ü") == 1
    assert {r.location_key for r in store.read(schemas.READINGS).collect()} == {"other"}
    assert pipeline.land(store, payload(4), NOW, hour - dt.timedelta(days=1)).status == "empty"
    places = spark.createDataFrame([("other", 1.0, 2.0), ("new", 3.0, 4.0)], "location_key string, latitude double, longitude double")
    assert pipeline.backfill_requests(places, DAY, DAY + dt.timedelta(days=99)).count() == 4
    assert [tuple(r) for r in pipeline.current_requests(store, places, DAY).select("location_key", "chunk_start", "chunk_end").collect()] == [("other", hour.date(), DAY)]


def test_gate_stops_a_bad_batch_until_it_is_mended(spark, readings, tmp_path):
    store = Store(spark, str(tmp_path))
    gate = checks.Gate({"in range": F.coalesce("aqi", F.lit(0)).between(0, 500), "known": F.col("location_key").isNotNull()}, now=NOW, max_hours=24 * 30, least=1.0)
    rows = readings.filter("location_key = 'view'")
    run = lambda part: {r.stage: r for r in pipeline.run_pipeline(store, arrived=lambda: pipeline.land_rows(store, part, "upsert"), gate=gate, at=NOW, skip=["dim_date", "dim_time", "episodes"]).collect()}
    old = rows.filter(F.col("date_utc") < DAY)
    good = run(old)
    assert [good[s].status for s in ("clean", "validate", "hourly", "daily")] == ["done"] * 4 and good["validate"].rows == old.count()
    bad = run(rows.filter(F.col("date_utc") == DAY).withColumn("aqi", F.when(F.hour("ts_utc") < 12, F.lit(9999)).otherwise(F.col("aqi"))))
    assert [bad[s].status for s in ("clean", "validate", "hourly", "daily")] == ["done", "failed", "skipped", "skipped"] and "in range" in bad["validate"].error
    held = store.read(schemas.QUARANTINE).collect()
    assert held and all(r.broken == ["in range"] and '"aqi":9999' in r.row for r in held)
    assert run(rows.filter("false"))["validate"].status == "failed"
    mended = run(rows.filter(F.col("date_utc") == DAY))
    assert [mended[s].status for s in ("clean", "validate", "hourly", "daily")] == ["done"] * 4
    assert store.count(schemas.HOURLY) == rows.filter(F.col("date_utc") <= DAY).count()
    assert run(rows.filter("false"))["validate"].status == "empty"
    # One scan for all checks.
    flagged = gate.flagged(store.read(schemas.CLEAN))
    assert gate.report(flagged, 1)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["check"]: r.passed for r in gate.report(flagged, 10**6).collect()} == {"duplicates": True, "in range": True, "known": True, "freshness": True, "retention": False}


def test_backfill_goes_on_where_it_failed(spark, readings, tmp_path):
    store, seen = Store(spark, str(tmp_path)), []
    rows = readings.filter("location_key = 'view'")

    def arrived(broken, a, b):
        seen.append(a.day)
        if broken and a.day == 7:
            raise OSError("no answer")
        return pipeline.land_rows(store, rows.filter(F.col("date_utc").between(a, b)))

    a, b = dt.date(2024, 1, 1), dt.date(2024, 1, 15)
    options = {"at": NOW, "days": 3, "skip": ["dim_date", "dim_time", "episodes", "daily"]}
    first = pipeline.run_backfill(store, a, b, lambda *x: arrived(True, *x), **options).collect()
    assert [(r.chunk_start.day, r.status) for r in first] == [(1, "done"), (4, "done"), (7, "failed")] and "no answer" in first[-1].error
    seen.clear()
    second = pipeline.run_backfill(store, a, b, lambda *x: arrived(False, *x), **options).collect()
    assert [r.status for r in second] == ["skipped"] * 2 + ["done"] * 3 and seen == [7, 10, 13]
    assert store.count(schemas.HOURLY) == rows.filter(F.col("date_utc").between(a, b)).count()


def test_registry_truncate_merge_checks(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.create_all(dry_run=True).count() == len(schemas.ALL) and not any(r.written for r in store.tables().collect())
    store.create_all()
    assert all(r.written for r in store.tables().collect()) and store.read(schemas.DAILY).schema.names == schemas.DAILY.schema.names
    rows = spark.createDataFrame([("a", "x", "u", None), ("b", "y", "u", "24h")], schemas.DIM_POLLUTANT.ddl)
    assert store.merge(schemas.DIM_POLLUTANT, rows) == 2
    with pytest.raises(ValueError, match="more than once"):
        store.merge(schemas.DIM_POLLUTANT, rows.unionByName(rows))
    assert store.truncate(schemas.DIM_POLLUTANT) == 2 and store.read(schemas.DIM_POLLUTANT).count() == 0
    actions = [(r.action, r.table) for r in store.create_all(drop=True).collect()]
    assert actions[0] == ("drop", "runs") and len(actions) == 2 * len(schemas.ALL)
    assert checks.schema_matches(rows, schemas.DIM_POLLUTANT.schema).first().passed
    assert checks.schema_matches(rows.drop("unit_default"), schemas.DIM_POLLUTANT.schema).first().value == 2


def test_status(full, spark):
    rows = {r.name: r for r in pipeline.status(full).collect()}
    assert rows["total"].pending == 0 and rows["total"].rating == "excellent"
    empty = Store(spark, full.root + "-none")
    assert {r.rating for r in pipeline.status(empty).collect()} == {"poor"}
    part = reports.layer_status(full.read(schemas.CLEAN), full.read(schemas.CLEAN).limit(0), "x").first()
    assert part.pending == part.source_rows and part.savings == 0


def test_training_job(full, tmp_path):
    found = pipeline.train_forecast(full, str(tmp_path), NOW, grid={"maxDepth": [2], "maxIter": [2, 3]}, sample=400)
    assert found["train_rows"] > 0 and found["rmse"] > 0 and found["latest"].count() == 10
    kinds = {r.kind for r in full.read(schemas.RUNS).filter(F.col("run_id") == found["run_id"]).collect()}
    assert kinds == {"parameter", "rows", "metric", "importance"}
    rows = forecast.supervised(full.read(schemas.CLEAN))
    assert pipeline.load_model(f"{tmp_path}/model").transform(rows).filter("prediction is null").count() == 0
    ordered = [(r.ts_utc, r.location_key) for r in files.read_predictions(full.spark, f"{tmp_path}/predictions").collect()]
    assert ordered == sorted(ordered)
    with pytest.raises(ValueError, match="fewer"):
        pipeline.train_forecast(full, str(tmp_path), NOW, min_rows=10**9)


def test_plans(full):
    hours = full.read(schemas.HOURLY)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    ranged = plan(hours.filter(tables.in_range("date_utc", DAY, DAY)))
    assert "PartitionFilters: [isnotnull(date_utc" in ranged
    # No window of episodes, runs, leads or ranks takes a location's rows as a whole: only rows of its months do.
    for df in (facts.episodes(hours), facts.runs(hours, 151), forecast.lead_label(hours, "pm25", 6), forecast.with_rank(hours)):
        specs = re.findall(r"windowspecdefinition\(([^()]*?ts_utc#[^()]*)", plan(df))
        assert specs and all("_segment#" in x or "date_utc#" in x for x in specs)
    late = plan(tables.after_watermark(hours, hours.filter("ts_utc <= '2024-01-20 12:00:00'"), day="date_utc"))
    assert "date_utc" in late.split("PartitionFilters: [")[1].split("]")[0] and "Join" not in late


def test_as_timestamp_and_clipped_mape(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "ts_utc string")
    assert forecast.as_timestamp(df).dtypes == [("ts_utc", "timestamp")]
    rows = spark.createDataFrame([(0.0, 1.0), (10.0, 5.0)], "label double, prediction double")
    assert (forecast.metrics(rows).first().mape, forecast.metrics(rows, least_label=1.0).first().mape) == (50.0, 75.0)


def test_failed_swap_puts_the_old_state_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    files.overwrite(spark.range(3), path)

    class Stuck:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            return ".new-" not in a.toString() and self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    at = files._at
    monkeypatch.setattr(files, "_at", lambda s, p: (Stuck(at(s, p)[0]), at(s, p)[1]))
    with pytest.raises(OSError, match="cannot be replaced"):
        files.overwrite(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
