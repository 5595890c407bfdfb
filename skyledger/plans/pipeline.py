"""The layers from readings to facts as library calls: land, clean, dimensions, hourly, daily, episodes, deletes, training.

A build is a pure transform, in ``operators``, and a write, here. Full builds write all; incremental ones the locations and
days that the store's log says have changed in the source since the stage last ran, in whatever order their rows came; a
range of days replaces the rows of these days and no others.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from contextlib import ExitStack
from dataclasses import asdict, dataclass
from datetime import date, datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions import calendar, measures
from skyledger.operators import checks, facts, forecast, reports, tables
from skyledger.schemas import Table
from skyledger.sources import files
from skyledger.sources.store import Changes, Store

FULL, INCREMENTAL = "full", "incremental"


@dataclass(frozen=True)
class Result:
    """What a stage did. ``status``: done, empty (nothing to do), skipped or failed."""

    stage: str
    mode: str
    status: str
    rows: int = 0
    start: date | None = None
    end: date | None = None
    seconds: float = 0.0
    error: str | None = None


_RESULT = "stage string, mode string, status string, rows long, start date, end date, seconds double, error string"


#: What the provider's rows are marked with.
SOURCE = {"model_domain": "CAMS", "request_timezone": "UTC"}


def land(store: Store, payload: DataFrame, ingested_at: datetime, now: datetime | None = None, mode: str = "insert", source: dict[str, str] = SOURCE) -> Result:
    """Lands a provider's payload (arrays of a location and span of time) in the readings, all locations in one job.

    Readings after ``now`` are dropped, indices are rounded half to even, and of one hour one row stays. ``source``: columns
    that say where the rows come from, where the payload has none of these names. ``mode``: insert (what is there stays), upsert (the new wins) or replace (all hours of the locations in the days of the payload).
    """
    index = ["aqi", *(f"aqi_{n}" for n in measures.SUB_INDICES)]
    rows = files.explode_payload(payload, [*index, *measures.MEASURES])
    rows = tables.drop_future(rows, now) if now else rows
    audit = {"_ingested_at": F.lit(ingested_at)} | {c: F.lit(v) for c, v in source.items() if c not in payload.columns}
    rows = rows.withColumns({c: measures.clean_int(F.col(c).cast("double")) for c in index} | audit)
    rows = tables.conform(rows, schemas.READINGS.schema)
    return land_rows(store, tables.latest(rows, list(facts.HOUR_ID), [F.xxhash64(*rows.columns).asc()]), mode)


def land_rows(store: Store, rows: DataFrame, mode: str = "insert") -> Result:
    began = time.time()
    with store.staging(tables.conform(rows, schemas.READINGS.schema)) as new:
        span = new.rows.agg(F.min("date_utc").alias("a"), F.max("date_utc").alias("b")).first()
        if not new.n:
            return Result("land", mode, "empty")
        if mode == "replace":
            held = store.read(schemas.READINGS).filter(tables.in_range("date_utc", span["a"], span["b"])).select("location_key", "date_utc").distinct()
            with store.staging(held.join(new.rows.select("location_key").distinct(), "location_key", "left_semi")) as gone:
                n = store.replace(schemas.READINGS, gone, new.rows)
        else:
            n = store.merge(schemas.READINGS, new.rows, update=mode == "upsert")
    return Result("land", mode, "done" if n else "empty", n, span["a"], span["b"], round(time.time() - began, 3))


def backfill_requests(locations: DataFrame, start: date, end: date, days: int = 90) -> DataFrame:
    """The payloads to ask for: each location by chunks of ``days``."""
    span = locations.select("location_key", "latitude", "longitude", F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar.date_chunks(span, days)


def current_requests(store: Store, locations: DataFrame, today: date) -> DataFrame:
    """Of locations that have readings the days from their latest to ``today``."""
    latest = reports.latest_per_key(store.read(schemas.READINGS))
    return locations.join(latest, "location_key").select("location_key", "latitude", "longitude", F.to_date("latest").alias("chunk_start"), F.lit(today).alias("chunk_end"))


def _build(store: Store, stage: str, table: Table, source: Table, make: Callable[[DataFrame], DataFrame], mode: str, start: date | None, end: date | None) -> Result:
    """Rows of ``table`` made from those of ``source``: in a range of days, or of all locations and days that changed since the
    stage last ran, whenever their rows came. A location's day is made whole, so rows that are gone go here too."""
    began = time.time()
    ranged, made = start is not None or end is not None, lambda rows: tables.conform(make(rows), table.schema)
    done = lambda n, a, b: Result(stage, mode, "done" if n else "empty", n, a, b, round(time.time() - began, 3))
    if ranged:
        days = tables.in_range("date_utc", start, end)
        new = made(store.read(source).filter(days))
        return done(store.replace(table, days, new) if mode == FULL else store.merge(table, new), start, end)
    changed = store.changes(source, None if mode == FULL else store.frontier(stage, source))
    if changed is None:
        return done(0, None, None)
    if changed.everything:
        n = store.overwrite(table, made(store.read(source)))
    else:
        with store.staging(changed.where) as where:
            span = where.rows.agg(F.min("date_utc").alias("a"), F.max("date_utc").alias("b")).first()
            start, end = span["a"], span["b"]
            n = store.replace(table, where, made(store.matching(source, where)))
    store.advance(stage, source, changed.upto)
    return done(n, start, end)


def clean_rows(readings: DataFrame) -> DataFrame:
    return facts.clean(readings, [F.desc("_ingested_at"), F.xxhash64(*readings.columns)])


def hourly_rows(rows: DataFrame) -> DataFrame:
    return facts.hourly(rows).withColumn("record_id", measures.stable_id(F.col("location_key"), F.date_format("ts_utc", "yyyyMMddHH")))


def daily_rows(hours: DataFrame) -> DataFrame:
    named = facts.daily(hours).withColumnsRenamed({f"{b}_hours": f"hours_in_cat_{b}" for b in measures.BANDS})
    return named.withColumn("daily_record_id", measures.stable_id(F.col("location_key"), F.date_format("date_utc", "yyyyMMdd")))


def episode_rows(found: DataFrame, threshold: int = 151, min_hours: int = 4) -> DataFrame:
    """Rows of the table from runs over days."""
    found = facts.long_runs(found, threshold, min_hours).withColumnsRenamed({"start_ts": "start_ts_utc", "end_ts": "end_ts_utc", "start_date": "start_date_utc"})
    return found.withColumn("episode_id", measures.stable_id(F.col("location_key"), F.date_format("start_ts_utc", "yyyyMMddHH"), F.col("rule_code")))


def build_clean(store: Store, mode: str = INCREMENTAL, start: date | None = None, end: date | None = None) -> Result:
    return _build(store, "clean", schemas.CLEAN, schemas.READINGS, clean_rows, mode, start, end)


def build_hourly(store: Store, mode: str = INCREMENTAL, start: date | None = None, end: date | None = None) -> Result:
    return _build(store, "hourly", schemas.HOURLY, schemas.CLEAN, hourly_rows, mode, start, end)


def build_daily(store: Store, mode: str = INCREMENTAL, start: date | None = None, end: date | None = None) -> Result:
    return _build(store, "daily", schemas.DAILY, schemas.HOURLY, daily_rows, mode, start, end)


#: Days that are looked at around changed ones before more are.
REACH_DAYS = 8


def _around(store: Store, where: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """location_key, after, until (null: open): the hours between which runs may have changed, of each location in ``where``.

    A day that a run does not fill from its first to its last known hour parts what lies before from what lies behind. So the
    nearest such days on both sides are looked for, in the summaries of REACH_DAYS around the changed days, then of four
    times as many for the locations where that was not enough, at most to ``first`` and ``last``, the ends of the table.
    """
    rest = where.filter("date_utc is not null").groupBy("location_key").agg(F.min("date_utc").alias("a"), F.max("date_utc").alias("b"))
    ends, reach, found = rest.agg(F.min("a").alias("a"), F.max("b").alias("b")).first(), REACH_DAYS, []
    while ends["a"] is not None:
        low, high = ends["a"] - timedelta(days=reach), ends["b"] + timedelta(days=reach)
        seen = files.kept(_parted(store, rest, low, high), "around")
        # Where the table has no more days there is nothing to part from.
        enough = (F.col("after").isNotNull() | F.lit(first is None or low <= first)) & (F.col("until").isNotNull() | F.lit(last is None or high >= last))
        found.append(seen.filter(enough).select("location_key", "after", "until"))
        rest = seen.filter(~enough).select("location_key", "a", "b")
        ends, reach = rest.agg(F.min("a").alias("a"), F.max("b").alias("b")).first(), 4 * reach
    return reports.union(found) if found else store.spark.createDataFrame([], "location_key string, after timestamp, until timestamp")


def _parted(store: Store, spans: DataFrame, low: date, high: date) -> DataFrame:
    """``spans`` (location_key, a, b) with after and until, by the nearest parting days before a and behind b, from ``low`` to ``high``."""
    days = store.read(schemas.DAY_RUNS).filter(tables.in_range("date_utc", low, high)).withColumns({"_first": F.get("runs", F.lit(0)), "_last": F.try_element_at("runs", F.lit(-1))})
    fills = F.col("first_flag") & F.col("last_flag") & (F.size("runs") == 1)
    # Its first run may have begun before, its last one may go on: what lies behind the one and before the other is its own.
    after = F.when(F.col("first_flag"), F.col("_first.end_ts")).otherwise(F.timestamp_add("SECOND", F.lit(-1), F.col("first_ts")))
    until = F.when(F.col("last_flag"), F.col("_last.start_ts")).otherwise(F.timestamp_add("SECOND", F.lit(1), F.col("last_ts")))
    days = days.filter(~fills).select("location_key", "date_utc", after.alias("after"), until.alias("until"))
    near = spans.alias("s").join(days.alias("d"), F.col("s.location_key").eqNullSafe(F.col("d.location_key")), "left").groupBy("s.location_key", "s.a", "s.b")
    return near.agg(
        F.max_by("d.after", F.when(F.col("d.date_utc") < F.col("s.a"), F.col("d.date_utc"))).alias("after"),
        F.min_by("d.until", F.when(F.col("d.date_utc") > F.col("s.b"), F.col("d.date_utc"))).alias("until"),
    )


def build_episodes(store: Store, mode: str = INCREMENTAL, start: date | None = None, end: date | None = None, threshold: int = 151, min_hours: int = 4, break_on_gap: bool = False) -> Result:
    """Episodes from summaries of days, which are kept: changed days are summed up anew, and of their locations the runs that
    touch them or the days next to them are joined again. Other days of hours are not read.

    With a range all runs that may touch its days are made anew. Another rule than last time makes everything anew.
    """
    began, table, days = time.time(), schemas.EPISODES, schemas.DAY_RUNS
    rule = f"{threshold}_{min_hours}_{int(break_on_gap)}"
    ranged = start is not None or end is not None
    made = lambda runs: tables.conform(episode_rows(facts.joined_runs(runs, break_on_gap), threshold, min_hours), table.schema)
    mark = store.frontier("episodes", schemas.HOURLY, rule)
    changed = store.changes(schemas.HOURLY, None if mode == FULL and not ranged else mark)
    done = lambda n, a, b: Result("episodes", mode, "done" if n else "empty", n, a, b, round(time.time() - began, 3))
    if ranged and mark is not None and not (changed and changed.everything):
        hours = store.read(schemas.HOURLY).filter(tables.in_range("date_utc", start, end)).select("location_key", "date_utc").distinct()
        gone = store.read(days).filter(tables.in_range("date_utc", start, end)).select("location_key", "date_utc")
        where = reports.union([hours, gone, *([changed.where] if changed else [])]).distinct()
        changed = Changes(changed.upto if changed else mark, False, where)
    if changed is None:
        return done(0, None, None)
    if changed.everything:
        store.overwrite(days, facts.day_runs(store.read(schemas.HOURLY), threshold, break_on_gap))
        n = store.overwrite(table, made(store.read(days)))
    else:
        with store.staging(changed.where) as where:
            span = where.rows.agg(F.min("date_utc").alias("a"), F.max("date_utc").alias("b")).first()
            start, end = (span["a"], span["b"]) if not ranged else (start, end)
            store.replace(days, where, facts.day_runs(store.matching(schemas.HOURLY, where), threshold, break_on_gap))
            n = _rejoin(store, where.rows, made)
    store.advance("episodes", schemas.HOURLY, changed.upto, rule)
    return done(n, start, end)


def _rejoin(store: Store, where: DataFrame, made: Callable[[DataFrame], DataFrame]) -> int:
    """Makes the runs around changed days anew in the episodes; rows written."""
    table, days = schemas.EPISODES, schemas.DAY_RUNS
    with store.staging(_around(store, where, store.first_day(days), store.latest_day(days))) as spans:
        if not spans.n:
            return 0
        ends = spans.rows.agg(F.min("after").alias("a"), F.max("until").alias("b"), F.count_if(F.col("after").isNull()).alias("from"), F.count_if(F.col("until").isNull()).alias("to")).first()
        low, high = None if ends["from"] else ends["a"].date() - timedelta(days=1), None if ends["to"] else ends["b"].date()
        same = F.col("r.location_key").eqNullSafe(F.col("s.location_key"))
        inside = lambda ts: (F.col("after").isNull() | (ts > F.col("after"))) & (F.col("until").isNull() | (ts < F.col("until")))
        near = store.read(days).filter(tables.in_range("date_utc", low, high)).alias("r").join(spans.hinted(spans.rows).alias("s"), same).select("r.*", "after", "until")
        runs = F.filter("runs", lambda x: inside(x["start_ts"]))
        # A run that is left out here is left whole: its day then begins or ends without a flag.
        cut = near.withColumns({"_kept": runs, "_n": F.size("runs")}).withColumns({
            "first_flag": F.col("first_flag") & (F.get("_kept", F.lit(0))["start_ts"] == F.get("runs", F.lit(0))["start_ts"]),
            "last_flag": F.col("last_flag") & (F.try_element_at("_kept", F.lit(-1))["start_ts"] == F.try_element_at("runs", F.lit(-1))["start_ts"]),
        }).withColumns({"runs": F.col("_kept"), "first_flag": F.coalesce("first_flag", F.lit(False)), "last_flag": F.coalesce("last_flag", F.lit(False))})
        new = made(cut.select(*days.schema.names))
        old = store.read(table).filter(tables.in_range("start_date_utc", low, high)).alias("r").join(spans.hinted(spans.rows).alias("s"), same & inside(F.col("r.start_ts_utc")), "left_semi")
        with store.staging(old.select("start_date_utc", "location_key", "start_ts_utc")) as gone:
            return store.replace(table, gone, new)


def build_dim_date(store: Store, mode: str = INCREMENTAL) -> Result:
    """The dates of the clean rows: all, or with those that came since the last run added."""
    began, stage, n = time.time(), "dim_date", 0
    changed = store.changes(schemas.CLEAN, None if mode == FULL else store.frontier(stage, schemas.CLEAN))
    if changed and changed.everything:
        n = store.overwrite(schemas.DIM_DATE, calendar.dim_date(store.read(schemas.CLEAN)))
    elif changed:
        with store.staging(changed.where.select("date_utc").distinct()) as where:
            n = store.merge(schemas.DIM_DATE, calendar.dim_date(store.matching(schemas.CLEAN, where).select("date_utc")), update=False)
    if changed:
        store.advance(stage, schemas.CLEAN, changed.upto)
    return Result(stage, mode, "done" if n else "empty", n, seconds=round(time.time() - began, 3))


def validate(store: Store, gate: checks.Gate, at: datetime, source: Table = schemas.CLEAN, before: Table | None = schemas.READINGS) -> Result:
    """Checks the rows of ``source`` that changed since the gate last let rows pass: all checks in one scan. Rows that break a
    rule go to the quarantine; where a check fails the stage does, and the same rows are checked again the next time.

    The checks are recorded with the runs. ``before``: the table whose rows in the same places ``least`` is a share of.
    """
    began = time.time()
    changed = store.changes(source, store.frontier("validate", source))
    if changed is None:
        return Result("validate", INCREMENTAL, "empty", seconds=round(time.time() - began, 3))
    with ExitStack() as stack:
        where = None if changed.everything else stack.enter_context(store.staging(changed.where))
        rows = store.read(source) if where is None else store.matching(source, where)
        flagged = stack.enter_context(store.staging(gate.flagged(rows)))
        n_before = None
        if before and gate.least is not None:
            n_before = store.count(before) if where is None else store.matching(before, where).count()
        found = gate.report(flagged.rows, n_before).collect()
        bad = flagged.rows.filter(F.size("broken") > 0)
        failed = [r["check"] for r in found if not r["passed"]]
        if any(r["value"] and r["check"] not in ("freshness", "retention", "duplicates") for r in found):
            store.append(schemas.QUARANTINE, bad.select(F.lit(source.name).alias("source"), "broken", F.to_json(F.struct(*source.schema.names)).alias("row"), F.lit(at).alias("at")))
        record_run(store, {"check": {r["check"]: r["value"] for r in found}}, at)
        if failed:
            raise ValueError(f"{source.name}: failed {', '.join(failed)}")
        n = flagged.n
    store.advance("validate", source, changed.upto)
    return Result("validate", INCREMENTAL, "done", n, seconds=round(time.time() - began, 3))


def build_dimension(store: Store, table: Table, rows: DataFrame) -> Result:
    began = time.time()
    return Result(table.name, FULL, "done", store.overwrite(table, rows), seconds=round(time.time() - began, 3))


def run_stages(stages: Iterable[tuple[str, str, Callable[[], Result]]], skip: Iterable[str] = ()) -> list[Result]:
    """Runs stages in order. After a failed stage the others are skipped; a failed dimension stops nothing."""
    out, stopped = [], False
    for name, mode, stage in stages:
        if stopped or name in set(skip):
            out.append(Result(name, mode, "skipped"))
            continue
        began = time.time()
        try:
            out.append(stage())
        except Exception as e:  # reported as the stage's result
            out.append(Result(name, mode, "failed", seconds=round(time.time() - began, 3), error=f"{type(e).__name__}: {e}"[:1000]))
            stopped = not name.startswith("dim_")
    return out


def _dimension_stages(store: Store, mode: str, locations: str | None, pollutants: str | None) -> list:
    spark = store.spark
    out = [("dim_date", mode, lambda: build_dim_date(store, mode)), ("dim_time", FULL, lambda: build_dimension(store, schemas.DIM_TIME, calendar.dim_time(spark)))]
    if locations:
        out.append(("dim_location", FULL, lambda: build_dimension(store, schemas.DIM_LOCATION, files.read_locations(spark, locations))))
    if pollutants:
        out.append(("dim_pollutant", FULL, lambda: build_dimension(store, schemas.DIM_POLLUTANT, files.read_pollutants(spark, pollutants))))
    return out


def _fact_stages(store: Store, mode: str, start: date | None, end: date | None) -> list:
    builds = {"hourly": build_hourly, "daily": build_daily, "episodes": build_episodes}
    return [(name, mode, lambda b=build: b(store, mode, start, end)) for name, build in builds.items()]


def _reported(store: Store, results: list[Result]) -> DataFrame:
    return store.spark.createDataFrame([tuple(asdict(r).values()) for r in results], _RESULT)


def run_gold(store: Store, mode: str = INCREMENTAL, select: str | Iterable[str] = "all", start: date | None = None, end: date | None = None, locations: str | None = None, pollutants: str | None = None) -> DataFrame:
    """Dimensions and facts; ``select``: all, dims, facts or names of stages. A row for each stage."""
    dims, built = _dimension_stages(store, mode, locations, pollutants), _fact_stages(store, mode, start, end)
    chosen = {"all": [*dims, *built], "dims": dims, "facts": built}.get(select) if isinstance(select, str) else None
    if chosen is None:
        names = {select} if isinstance(select, str) else set(select)
        if unknown := names - {s[0] for s in (*dims, *built)}:
            raise ValueError(f"no stages {sorted(unknown)}")
        chosen = [s for s in (*dims, *built) if s[0] in names]
    return _reported(store, run_stages(chosen))


def run_pipeline(
    store: Store, mode: str = INCREMENTAL, start: date | None = None, end: date | None = None, arrived: Callable[[], Result] | None = None,
    skip: Iterable[str] = (), locations: str | None = None, pollutants: str | None = None, gate: checks.Gate | None = None, at: datetime | None = None,
) -> DataFrame:
    """All layers in one session; a row for each stage. With ``gate`` the clean rows are validated before facts are made of them.

    ``mode``: incremental, backfill (the days from ``start`` to ``end`` are replaced) or dims-only. ``arrived`` lands what is
    new first. ``skip`` names stages to leave out.
    """
    if mode not in (INCREMENTAL, "backfill", "dims-only"):
        raise ValueError(f"no mode {mode}")
    build = FULL if mode == "backfill" else INCREMENTAL
    dims = _dimension_stages(store, build if start is None and end is None else INCREMENTAL, locations, pollutants)
    stages = [("land", mode, arrived)] if arrived else []
    stages.append(("clean", build, lambda: build_clean(store, build, start, end)))
    if gate:
        stages.append(("validate", INCREMENTAL, lambda: validate(store, gate, at or datetime.now())))
    return _reported(store, run_stages(dims if mode == "dims-only" else [*stages, *dims, *_fact_stages(store, build, start, end)], skip))


def run_backfill(store: Store, start: date, end: date, arrived: Callable[[date, date], Result], at: datetime, days: int = 30, run_id: str | None = None, **options: object) -> DataFrame:
    """A backfill in chunks of ``days``: each is landed by ``arrived`` (its first and last day) and built, and what became of it is
    recorded with the runs. chunk_start, chunk_end, status, error of each chunk of this call.

    A chunk that fails ends the call; the next one with the same ``run_id`` (by default the range's) begins there. Chunks that
    are done are not made again.
    """
    run_id = run_id or f"backfill {start} {end} {days}"
    told = store.read(schemas.RUNS).filter((F.col("run_id") == run_id) & (F.col("kind") == "chunk") & (F.col("value") == "done"))
    done, rows, first = {r["name"] for r in told.select("name").collect()}, [], start  # one row a chunk
    while first <= end:
        last = min(first + timedelta(days=days - 1), end)
        name = f"{first} {last}"
        if name in done:
            rows.append((first, last, "skipped", None))
        else:
            report = run_pipeline(store, "backfill", first, last, arrived=lambda a=first, b=last: arrived(a, b), **options).collect()
            error = next((r["error"] for r in report if r["status"] == "failed"), None)
            rows.append((first, last, "failed" if error else "done", error))
            record_run(store, {"chunk": {name: rows[-1][2]}}, at, run_id)
            if error:
                break
        first = last + timedelta(days=1)
    return store.spark.createDataFrame(rows, "chunk_start date, chunk_end date, status string, error string")


def _range_of(table: Table, start: date, end: date, overlap: bool = False) -> Column:
    """Rows of a table in a range of days: by its date, by its date key, or episodes that start or end there."""
    if table is schemas.EPISODES:
        return facts.episodes_touching(start, end, overlap, "start_date_utc", "end_ts_utc")
    days = tables.in_range("date_utc", start, end)
    return days & tables.in_range("date_key", int(start.strftime("%Y%m%d")), int(end.strftime("%Y%m%d"))) if table is schemas.DAILY else days


def _count(store: Store, table: Table, rows: Column) -> int:
    """Of rows in a range of days; from footers where the range is one of partitions."""
    return store.count(table, rows) if table.logged else store.read(table).filter(rows).count()


RANGED = {"readings": schemas.READINGS, "clean": schemas.CLEAN, "hourly": schemas.HOURLY, "daily": schemas.DAILY, "episodes": schemas.EPISODES}


def range_counts(store: Store, start: date, end: date) -> DataFrame:
    """Rows of each layer's tables in a range of days."""
    return reports.row_counts({n: store.read(t).filter(_range_of(t, start, end)) for n, t in RANGED.items()})


def delete_range(store: Store, start: date, end: date, layers: Iterable[str] = tuple(RANGED), dry_run: bool = False, overlap: bool = False, dimensions: bool = False) -> DataFrame:
    """table, before (rows in the range), deleted, after. ``dimensions`` empties these too; ``dry_run`` only counts."""
    rows = []
    for name in layers:
        table = RANGED[name]
        gone = _range_of(table, start, end, overlap)
        before = _count(store, table, gone)
        deleted = 0 if dry_run or not before else store.delete(table, gone)
        rows.append((name, before, deleted, _count(store, table, gone)))
    for table in schemas.DIMENSIONS if dimensions else ():
        before = store.count(table)
        deleted = 0 if dry_run or not before else store.truncate(table)
        rows.append((table.name, before, deleted, store.count(table)))
    return store.spark.createDataFrame(rows, "table string, before long, deleted long, after long")


def _layer_status(store: Store, source: Table, target: Table) -> DataFrame:
    """As ``reports.layer_status``, from footers and names of folders; rows are read of the one day that both may share."""
    name, by_day = f"{source.name} to {target.name}", target.clock == "date_utc"
    rows, mark = store.count(source), store.latest(target)
    if mark is None:
        pending = rows
    elif by_day:
        pending = store.count(source, F.col("date_utc") > F.lit(mark))
    else:
        day = F.lit(mark.date())
        pending = store.count(source, F.col("date_utc") > day) + store.read(source).filter((F.col("date_utc") == day) & (F.col(source.clock) > F.lit(mark))).count()
    values = (name, rows, store.count(target), store.latest_day(source) if by_day else store.latest(source), mark, pending)
    kind = "date" if by_day else "timestamp"
    return reports.rated(store.spark.createDataFrame([values], f"name string, source_rows long, target_rows long, source_latest {kind}, target_latest {kind}, pending long"))


def status(store: Store) -> DataFrame:
    """How far each layer is behind its source, and in total."""
    pairs = ((schemas.READINGS, schemas.CLEAN), (schemas.CLEAN, schemas.HOURLY), (schemas.HOURLY, schemas.DAILY))
    return reports.status_total([_layer_status(store, s, t) for s, t in pairs])


def record_run(store: Store, values: dict[str, dict[str, object]], at: datetime, run_id: str | None = None) -> str:
    """Appends values by kind (parameters, metrics, importances) and name to the runs; the run's id."""
    run_id = run_id or uuid.uuid4().hex
    rows = [(run_id, kind, name, None if v is None else str(v), at) for kind, each in values.items() for name, v in each.items()]
    store.append(schemas.RUNS, store.spark.createDataFrame(rows, schemas.RUNS.ddl))
    return run_id


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_forecast(
    store: Store, out: str, at: datetime, ahead: int = 6, min_rows: int = 0, sample: int = 0, ratio: float = 0.8, seed: int = 42, grid: dict | None = None, latest: int = 10
) -> dict[str, object]:
    """Learns the forecast from the clean rows: writes the model and the predictions of the later part under ``out``, records the
    run, and returns its id, metrics and the ``latest`` predictions (ten at least) as a frame."""
    rows = forecast.supervised(store.read(schemas.CLEAN), ahead, min_rows=min_rows, sample=sample, seed=seed)
    train, test = forecast.chronological_split(rows, ratio)
    sizes = {"train_rows": train.count(), "test_rows": test.count()}
    if not all(sizes.values()):
        raise ValueError(f"nothing to learn from or to test on: {sizes}")
    model = forecast.fit(train, seed, grid)
    save_model(model, f"{out}/model")
    files.write_csv(model.transform(test).select("location_key", "ts_utc", "label", "prediction"), f"{out}/predictions")
    predictions = files.read_predictions(store.spark, f"{out}/predictions")
    metrics = {k: v for k, v in forecast.metrics(predictions).first().asDict().items() if k != "n"}
    parameters = {"ahead": ahead, "ratio": ratio, "seed": seed, "sample": sample, "grid": grid}
    run_id = record_run(store, {"parameter": parameters, "rows": sizes, "metric": metrics, "importance": dict(forecast.importances(model))}, at)
    return {"run_id": run_id, **sizes, **metrics, "latest": reports.first_rows(predictions, [F.desc("ts_utc"), "location_key"], max(10, latest))}
