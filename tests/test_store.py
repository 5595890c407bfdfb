import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.operators import facts
from skyledger.plans import pipeline
from skyledger.schemas import Table
from skyledger.sources import store as stores
from skyledger.sources.store import Partitions, Store

BY_DAY = Table("bronze", "t", "k int, v string, day string", ("k",), ("day",))
DAYS = Table("bronze", "d", "k string, day date, v int", ("k", "day"), ("day",), logged=("k", "day"))


def rows(store, table):
    return sorted(map(str, map(tuple, store.read(table).collect())))


def said(values):
    return sorted(map(str, values))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


@pytest.fixture
def filled(spark, store):
    store.append(BY_DAY, spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", "x"), (4, "d", "y"), (None, "n", "x")], BY_DAY.ddl))
    return store


def test_null_partitions_keep_their_rows(spark, filled):
    assert filled.delete(BY_DAY, F.col("k") == 1) == 1
    assert rows(filled, BY_DAY) == said([(2, "b", None), (3, "c", "x"), (4, "d", "y"), (None, "n", "x")])
    filled.merge(BY_DAY, spark.createDataFrame([(9, "new", None), (8, "empty name", ""), (None, "m", "x"), (None, "o", "x")], BY_DAY.ddl))
    assert rows(filled, BY_DAY) == said([(2, "b", None), (9, "new", None), (8, "empty name", None), (3, "c", "x"), (4, "d", "y"), (None, "n", "x"), (None, "m", "x"), (None, "o", "x")])
    assert filled.delete(BY_DAY, F.col("day").isNull()) == 3
    assert rows(filled, BY_DAY) == said([(3, "c", "x"), (4, "d", "y"), (None, "n", "x"), (None, "m", "x"), (None, "o", "x")])


def test_a_key_that_moves_to_another_partition_is_there_once(spark, filled):
    filled.merge(BY_DAY, spark.createDataFrame([(3, "moved", "z"), (4, "same", "y")], BY_DAY.ddl))
    assert rows(filled, BY_DAY) == said([(1, "a", None), (2, "b", None), (3, "moved", "z"), (4, "same", "y"), (None, "n", "x")])
    assert filled.merge(BY_DAY, spark.createDataFrame([(3, "late", "x"), (5, "e", "y")], BY_DAY.ddl), update=False) == 1
    assert (5, "e", "y") in {tuple(r) for r in filled.read(BY_DAY).collect()} and filled.read(BY_DAY).filter("k = 3").count() == 1


def test_a_row_must_lie_where_its_key_says(spark, store):
    hour = dt.datetime(2024, 1, 1)
    wrong = spark.createDataFrame([("a", hour, dt.date(2024, 1, 2))], "location_key string, ts_utc timestamp, date_utc date")
    with pytest.raises(ValueError, match="where its key says"):
        store.merge(schemas.HOURLY, wrong)


@pytest.mark.parametrize("gone", ["column", "rows"])
def test_replace_is_one_write(spark, filled, gone):
    before = rows(filled, BY_DAY)
    new = spark.createDataFrame([(7, "g", "w")], BY_DAY.ddl)
    bad = new.withColumn("v", F.raise_error(F.lit("no source")))
    with filled.staging(spark.createDataFrame([("x",), (None,)], "day string")) as days:
        what = days if gone == "rows" else F.col("day").isNull() | (F.col("day") == "x")
        with pytest.raises(Exception, match="no source"):
            filled.replace(BY_DAY, what, bad)
        assert rows(filled, BY_DAY) == before
        assert filled.replace(BY_DAY, what, new) == 1
    assert rows(filled, BY_DAY) == said([(4, "d", "y"), (7, "g", "w")])
    assert sorted(p.name for p in __import__("pathlib").Path(filled.path(BY_DAY)).iterdir() if p.is_dir()) == ["day=w", "day=y"]


def test_many_partitions_are_not_named(spark, store, monkeypatch):
    monkeypatch.setattr(stores, "NAMED_PARTITIONS", 2)
    first = dt.date(2024, 1, 1)
    at = [first + dt.timedelta(days=i) for i in range(6)]
    store.append(DAYS, spark.createDataFrame([*[(k, d, i) for i, d in enumerate(at) for k in "ab"], ("n", None, 9)], DAYS.ddl))
    found = Partitions(store.read(DAYS).select("day").distinct())
    assert found.named is None and found.within(store.read(DAYS)).count() == 13
    assert store.delete(DAYS, F.col("k") == "a") == 6
    assert store.delete(DAYS, F.col("day") < at[4]) == 4
    assert rows(store, DAYS) == said([("b", at[4], 4), ("b", at[5], 5), ("n", None, 9)])
    store.merge(DAYS, spark.createDataFrame([("b", d, 7) for d in at], DAYS.ddl))
    assert store.replace(DAYS, F.col("v") == 7, spark.createDataFrame([("c", at[0], 1)], DAYS.ddl)) == 1
    assert rows(store, DAYS) == said([("c", at[0], 1), ("n", None, 9)])


def test_merges_read_named_partitions_and_do_not_shuffle_the_table(spark, store, monkeypatch):
    at = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(5)]
    store.append(DAYS, spark.createDataFrame([(k, d, i) for i, d in enumerate(at) for k in "abc"], DAYS.ddl))
    kept, write = [], Store._write
    monkeypatch.setattr(Store, "_write", lambda self, df, table, mode, old=None: (kept.append(plan(old)), write(self, df, table, mode, old))[1])
    source = spark.createDataFrame([("a", at[1], 70), ("z", at[3], 71)], DAYS.ddl)
    assert store.merge(DAYS, source) == 2
    assert "PartitionFilters: [day" in kept[0] and "IN (2024-01-0" in kept[0].replace("day#", "").split("PartitionFilters")[1]
    assert "Exchange hashpartitioning" not in kept[0] and "BroadcastExchange" in kept[0]
    monkeypatch.setattr(stores, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(Store, "_write", write)
    assert store.merge(DAYS, spark.createDataFrame([("a", at[1], 80), (None, at[1], 81)], DAYS.ddl)) == 2
    expected = {(k, d): i for i, d in enumerate(at) for k in "abc"} | {("a", at[1]): 80, ("z", at[3]): 71, (None, at[1]): 81}
    assert rows(store, DAYS) == said([(*k, v) for k, v in expected.items()])


def test_order_decides_between_old_and_new(spark, store):
    first = dt.date(2024, 1, 1)
    put = lambda *r: store.merge(DAYS, spark.createDataFrame(list(r), DAYS.ddl), order=[F.desc("v")])
    put(("a", first, 5), ("b", first, 5))
    put(("a", first, 3), ("b", first, 8), ("c", first, None), (None, first, 1))
    assert rows(store, DAYS) == said([("a", first, 5), ("b", first, 8), ("c", first, None), (None, first, 1)])


def test_log_of_changes_and_frontiers(spark, store):
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    frame = lambda *r: spark.createDataFrame(list(r), DAYS.ddl)
    assert store.changes(DAYS, None) is None and store.frontier("s", DAYS) is None
    store.append(DAYS, frame(("a", first, 1), ("b", second, 2)))
    assert store.changes(DAYS, None).everything
    store.advance("s", DAYS, 1, "rule")
    assert (store.frontier("s", DAYS, "rule"), store.frontier("s", DAYS, "other")) == (1, None)
    assert store.changes(DAYS, 1) is None
    store.merge(DAYS, frame(("a", first, 1)), update=False)
    assert store.changes(DAYS, 1) is None  # nothing was new
    store.merge(DAYS, frame(("a", first, 3)))
    store.delete(DAYS, F.col("k") == "b")
    found = store.changes(DAYS, 1)
    assert not found.everything and said(map(tuple, found.where.collect())) == said([("a", first), ("b", second)])
    store.overwrite(DAYS, frame(("a", first, 1)))
    assert store.changes(DAYS, 1).everything and store.changes(DAYS, found.upto).everything
    store.advance("s", DAYS, store.changes(DAYS, 1).upto)
    assert store.changes(DAYS, store.frontier("s", DAYS)) is None and store.frontier("s", DAYS, "rule") is None


def test_counts_come_from_footers(spark, store):
    at = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(3)]
    hours = [("a", dt.datetime.combine(d, dt.time(h)), d, 1) for d in at for h in range(4)]
    store.append(schemas.HOURLY, spark.createDataFrame(hours, "location_key string, ts_utc timestamp, date_utc date, aqi int"))
    with store.footers():
        told = plan(store.sizes(schemas.HOURLY, F.col("date_utc") > F.lit(at[0])))
        assert "PushedAggregation: [COUNT(*)]" in told and "ReadSchema: struct<count(*):bigint>" in told
    assert store.count(schemas.HOURLY) == 12 and store.count(schemas.HOURLY, F.col("date_utc") > F.lit(at[0])) == 8
    assert store.count(schemas.HOURLY, F.col("date_utc") > F.lit(at[2])) == store.count(schemas.CLEAN) == 0
    assert (store.first_day(schemas.HOURLY), store.latest_day(schemas.HOURLY), store.latest(schemas.HOURLY)) == (at[0], at[2], hours[-1][1])
    assert store.latest(schemas.CLEAN) is None and "csv" in spark.conf.get("spark.sql.sources.useV1SourceList") and "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def _hour(k, i, aqi):
    at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
    return (k, at, at.date(), aqi, "pm25" if aqi and aqi % 2 else "o3")


@pytest.mark.parametrize("gap", [False, True])
def test_episodes_by_changed_days_equal_all_anew(spark, store, monkeypatch, gap):
    """Long runs over many days, gaps, corrections, days that vanish, in random order of arrival."""
    monkeypatch.setattr(pipeline, "REACH_DAYS", 1)
    rng, ddl = random.Random(int(gap)), "location_key string, ts_utc timestamp, date_utc date, aqi int, dominant_pollutant string"
    state = {}
    for step in range(5):
        puts = []
        for k in ("a", "b") if step != 2 else ("c",):
            days = rng.sample(range(24), 3) if step else [d for d in range(24) if d not in (5, 6, 15)]
            clock = lambda: range(at := rng.randrange(15), at + 10) if gap else rng.sample(range(24), 5)
            for i in (24 * d + h for d in days for h in clock()):
                puts.append(_hour(k, i, rng.choice([200, 180, 160, 155, 151, 20, None] if k == "a" and step > 1 else [200, 180, 151])))
        store.merge(schemas.HOURLY, spark.createDataFrame(puts, ddl))
        state |= {r[:2]: r for r in puts}
        if step == 3:
            day = dt.date(2024, 1, 9)
            store.delete(schemas.HOURLY, (F.col("date_utc") == day) & (F.col("location_key") == "b"))
            state = {k: r for k, r in state.items() if not (r[0] == "b" and r[2] == day)}
        pipeline.build_episodes(store, threshold=151, min_hours=4, break_on_gap=gap)
        assert pipeline.build_episodes(store, threshold=151, min_hours=4, break_on_gap=gap).status == "empty"
        expected = facts.episodes(spark.createDataFrame(list(state.values()), ddl), 151, 4, gap)
        columns = ["location_key", "start_ts", "end_ts", "peak_aqi", "hours_flagged", "duration_hours", "dominant_pollutant"]
        got = store.read(schemas.EPISODES).withColumnsRenamed({"start_ts_utc": "start_ts", "end_ts_utc": "end_ts"}).select(columns)
        assert said(map(tuple, got.collect())) == said(map(tuple, expected.select(columns).collect())), step
    assert pipeline.build_episodes(store, threshold=151, min_hours=30, break_on_gap=gap).rows < expected.count()  # another rule: all anew


def test_tables_as_views(spark, store):
    hours = spark.createDataFrame([(f"loc{i % 3}", dt.datetime(2024, 1, 1 + i // 24, i % 24), i) for i in range(72)], "location_key string, ts_utc timestamp, aqi int")
    full = hours.withColumn("date_utc", F.to_date("ts_utc"))
    full = full.select(*[F.col(c) if c in full.columns else F.lit(None).cast(t.dataType).alias(c) for c, t in ((f.name, f) for f in schemas.READINGS.schema)])
    store.append(schemas.READINGS, full)
    names = store.register("air_")
    assert len(names) == len(set(names)) == len(schemas.ALL)
    assert spark.sql("SELECT count(*) FROM air_gold_daily").first()[0] == 0
    some = spark.sql("SELECT location_key, max(aqi) AS top FROM air_bronze_readings WHERE date_utc = DATE'2024-01-02' GROUP BY location_key")
    assert "PartitionFilters: [isnotnull(date_utc" in plan(some)
    assert {tuple(r) for r in some.collect()} == {("loc0", 45), ("loc1", 46), ("loc2", 47)}
    store.delete(schemas.READINGS, F.col("location_key") == "loc1")
    store.register("air_")
    assert spark.sql("SELECT count(*) FROM air_bronze_readings").first()[0] == 48
    assert store.unregister("air_") == len(names) and store.unregister("air_") == 0
