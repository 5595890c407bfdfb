import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from skyledger.functions import measures
from skyledger.operators import checks, facts, forecast, tables
from skyledger.schemas import Table
from skyledger.sources import files
from skyledger.sources.store import Store
from skyledger.streaming import incremental

AQI = ["pm25", "pm10", "o3", "no2", "so2", "co"]


def test_dominant_ties_nulls_zeros(spark):
    schema = ", ".join(f"aqi_{n} int" for n in AQI)
    rows = [(None,) * 6, (0,) * 6, (None, 7, 7, 3, None, 7), (1, 2, 3, 4, 5, 6)]
    df = spark.createDataFrame(rows, schema).select(measures.dominant().alias("d"))
    assert [r.d for r in df.collect()] == [None, None, "pm10", "co"]


def test_clean_int_half_even_and_nan(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(measures.clean_int(F.col("x"))).collect()] == [0, 2, 2, None, None]


def test_band_edges(spark):
    values = [0, 50, 51, 100, 101, 150, 151, 200, 201, 300, 301, 501]
    df = spark.createDataFrame([(v,) for v in values], "aqi int").select(*[F.count_if(measures.in_band(F.col("aqi"), b)).alias(b) for b in measures.BANDS])
    assert list(df.first()) == [2, 2, 2, 2, 2, 2]


def _hours(spark, values):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t + dt.timedelta(hours=h), (t + dt.timedelta(hours=h)).date(), v, "pm25") for h, v in values]
    return spark.createDataFrame(rows, "location_key string, ts_utc timestamp, date_utc date, aqi int, dominant_pollutant string")


def test_episode_over_a_missing_hour(spark):
    df = _hours(spark, [(0, 160), (1, 170), (3, None), (4, 180), (5, 155), (6, 10), (7, 200)])
    (row,) = facts.episodes(df, 151, 4).collect()
    assert (row.duration_hours, row.hours_flagged, row.peak_aqi, row.rule_code) == (6, 4, 180, "AQI>=151_4h")
    assert facts.episodes(df, 151, 4, break_on_gap=True).count() == 0


def test_merges(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    assert {tuple(r) for r in tables.upsert(a, b, ["k"]).collect()} == {(1, "a"), (2, "x"), (3, "y"), (None, "n")}
    assert {tuple(r) for r in tables.insert_only(a, b, ["k"]).collect()} == {(1, "a"), (2, "b"), (3, "y"), (None, "n")}
    assert tables.delete_where(a, F.col("k") >= 2).count() == 2


def test_new_data_range_outcomes(spark):
    df = _hours(spark, [(0, 1), (30, 2)])
    assert tables.new_data_range(df, df.limit(0)).full
    assert tables.new_data_range(df, df).rows == 0
    found = tables.new_data_range(df, df.filter("aqi = 1"))
    assert (found.full, found.start, found.end, found.rows) == (False, dt.date(2024, 1, 2), dt.date(2024, 1, 2), 1)


def test_overwrite_of_what_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    files.overwrite(spark.range(5), path)
    files.overwrite(spark.read.parquet(path).filter("id > 2"), path)
    files.append(spark.range(1), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 3, 4]


@pytest.mark.parametrize("form", ["lines", "array", "object"])
def test_locations(spark, tmp_path, form):
    rows = [{"location_key": "x", "latitude": 1.0, "longitude": 2.0}, {"id": "y", "latitude": 3.0, "longitude": 4.0}, {"name": "z"}]
    text = {"lines": "\n".join(map(json.dumps, rows)) + "\n{bad", "array": json.dumps(rows), "object": json.dumps({"locations": rows})}[form]
    (tmp_path / "l.json").write_text(text)
    got = {r.location_key: r.latitude for r in files.read_locations(spark, str(tmp_path / "l.json")).collect()}
    assert got == {"x": 1.0, "y": 3.0, "z": None}


def test_locations_of_a_folder_with_all_forms(spark, tmp_path):
    files_of = {
        "a.json": '\n{"location_key": "a", "name": "Two locations mall"}\n{bad\n{"id": "b"}', "b.json": '{bad\n{"id": "c"}', "c.json": '[{"id": "d"},\n {"id": "e"}]', "d e.json": '{"locations": [{"id": "f"}]}',
        "f.json": '{\n "locations": [\n {"id": "g"}]}', "g.json": '{"locations": [{"id": "h"},\n {"id": "i"}]}', "h.json": "", "i.json": '{"location_key": "locations", "name": "locations"}',
    }
    for name, text in files_of.items():
        (tmp_path / name).write_text(text)
    assert sorted(r.location_key for r in files.read_locations(spark, str(tmp_path)).collect()) == [*"abcdefghi", "locations"]


def test_sample_of_whole_blocks(spark, monkeypatch):
    t = dt.datetime(2024, 1, 1)
    df = spark.range(24 * 70).select(F.expr("cast(id % 3 as string)").alias("location_key"), (F.lit(t) + F.expr("make_interval(0, 0, 0, 0, cast(id as int))")).alias("ts_utc"), "id")
    block = ["location_key", F.date_trunc("week", "ts_utc").alias("week")]
    whole = {tuple(r)[:2]: r["count"] for r in df.groupBy(*block).count().collect()}
    for cuts in (4096, 4):
        monkeypatch.setattr(forecast, "_CUTS", cuts)
        got = [forecast.sample_blocks(df, n, seed=3) for n in (500, 840, 1, 10**6)]
        for n, sample in zip((500, 840, 1, 1680), got, strict=True):
            found = {tuple(r)[:2]: r["count"] for r in sample.groupBy(*block).count().collect()}
            assert all(whole[k] == v for k, v in found.items()) and abs(sum(found.values()) - n) <= 56 / (1 if n == 1 else 2), n
    assert {r.id for r in forecast.sample_blocks(df, 500, seed=3).collect()} == {r.id for r in got[0].collect()} != {r.id for r in forecast.sample_blocks(df, 500, seed=4).collect()}


def test_csv_round_trip_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    files.write_csv(df, str(tmp_path / "c"), single=True)
    assert {tuple(r) for r in files.read_csv(spark, str(tmp_path / "c"), "k int, v string").collect()} == {(1, "a"), (2, None)}
    files.overwrite(df, str(tmp_path / "p"))
    report = files.export_csv(spark, {"p": str(tmp_path / "p"), "none": str(tmp_path / "none")}, str(tmp_path / "out"))
    assert {(r.table, r.rows, r.status) for r in report.collect()} == {("p", 2, "ok"), ("none", 0, "failed")}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "location_key string, ts_utc timestamp, date_utc date, aqi int, dominant_pollutant string")
    assert facts.episodes(empty).count() == 0
    assert not checks.retention(empty, empty, 0.9).first().passed


def test_forecast_end_to_end(spark):
    from skyledger.plans import fixtures

    train, test = forecast.chronological_split(forecast.supervised(fixtures.clean(spark, "/root/testdata/sf0.001")))
    model = forecast.fit(train, grid={"maxDepth": [2], "maxIter": [2, 3]})
    assert forecast.metrics(model.transform(test)).first().n > 0
    assert len(forecast.importances(model)) == len(forecast.FEATURES)


def test_stream_upserts_new_files(spark, tmp_path):
    land, ck = str(tmp_path / "land"), str(tmp_path / "ck")
    store, table = Store(spark, str(tmp_path / "root")), Table("bronze", "t", "k int, n int, day string", ("k",), ("day",))
    for rows in ([(1, 1, "a"), (1, 2, "a"), (2, 1, "b"), (3, 1, "c")], [(2, 5, "b"), (4, 1, "b")], [(2, 3, "b")]):
        spark.createDataFrame(rows, table.ddl).write.mode("append").parquet(land)
        before = {f: f.stat().st_mtime_ns for f in (tmp_path / "root").rglob("*.parquet") if "day=a" in str(f)}
        incremental.land_new_files(store, land, table, [F.desc("n")], ck).awaitTermination()
    assert {tuple(r) for r in store.read(table).collect()} == {(1, 2, "a"), (2, 5, "b"), (3, 1, "c"), (4, 1, "b")}
    assert before and all(f.stat().st_mtime_ns == t for f, t in before.items())


def test_read_table_by_name_path_and_fallback(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    spark.range(5).createOrReplaceTempView("by_name")
    assert files.read_table(spark, "by_name").count() == 5
    assert files.read_table(spark, str(tmp_path / "t")).count() == 3
    assert files.read_table(spark, "nowhere", str(tmp_path / "t")).count() == 3
    with pytest.raises(ValueError, match="nowhere"):
        files.read_table(spark, "nowhere")


def test_pollutants_and_full_locations(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"pollutant_code": "pm25", "display_name": "PM2.5", "unit_default": "u", "aqi_timespan": "24h"}\n{bad\n{"pollutant_code": "dust"}\n')
    assert sorted(map(tuple, files.read_pollutants(spark, str(tmp_path / "p.jsonl")).collect())) == [("dust", None, None, None), ("pm25", "PM2.5", "u", "24h")]
    (tmp_path / "l.json").write_text('{\n "locations": [\n  {"id": "a", "name": "Town", "latitude": 1.5, "timezone": "UTC"}\n ]\n}\n')
    assert [tuple(r) for r in files.read_locations(spark, str(tmp_path / "l.json")).collect()] == [("a", "Town", 1.5, None, "UTC")]
    (tmp_path / "e.json").write_text("")
    assert files.read_locations(spark, str(tmp_path / "e.json")).count() == 0
