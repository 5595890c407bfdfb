"""Parquet, JSON and CSV sources and sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """File system and path as the JVM has them: any store that Spark can read."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    if not fs.mkdirs(at):
        raise OSError(f"{path} cannot be made")


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    if fs.exists(at) and not fs.delete(at, True):
        raise OSError(f"{path} cannot be removed")


def names(spark: SparkSession, path: str) -> list[str]:
    """Of what lies in a folder; none where there is no folder."""
    fs, at = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def size(spark: SparkSession, path: str) -> int:
    fs, at = _at(spark, path)
    return fs.getContentSummary(at).getLength()


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session (dots as __) while the block runs."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def counted(seen: Observation) -> int:
    """The observed number of rows. Where the plan turned out to be empty Spark drops the observation with it."""
    try:
        return int(seen.get.get("rows", 0))
    except Py4JJavaError:
        return 0


#: Timestamps that have statistics in the files, so that scans skip by time and maxima need no data.
MICROS = {"spark__sql__parquet__outputTimestampType": "TIMESTAMP_MICROS"}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; it goes when the application ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, at = _at(spark, path)
    fs.deleteOnExit(at)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch and read back: its lineage ends there."""
    path = scratch(df.sparkSession, name)
    with settings(df.sparkSession, **MICROS):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, name: str, fallback: str | None = None) -> DataFrame:
    """A catalog table, or a parquet path; ``fallback`` is a path for where neither is found."""
    if "/" not in name and spark.catalog.tableExists(name):
        return spark.read.table(name)
    path = name if "/" in name else fallback
    if path is None:
        raise ValueError(f"no table {name} and no fallback path")
    return spark.read.parquet(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """location_key, location_name, latitude, longitude, timezone of JSON lines, an array, or {"locations": [...]}.

    The key is location_key, id or name. Each file of a folder has a form of its own, told by its first line that is not
    blank: an array begins with a bracket; an object has the member locations, or is not closed on that line; all else is
    lines. Only an array or object is read as a whole. Lines that are no JSON are left out.
    """
    fields = "location_key string, id string, name string, location_name string, latitude double, longitude double, timezone string"
    nested = f"locations array<struct<{', '.join(f.replace(' ', ': ') for f in fields.split(', '))}>>"
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"), F.trim("value").alias("v"))
    first = lines.filter("v <> ''").groupBy("file").agg(F.min_by("v", "at").alias("v"))
    opened = F.get_json_object("v", "$.locations").isNotNull() | F.col("v").rlike(r'^\{\s*("locations"\s*:.*)?$')
    form = F.when(F.col("v").startswith("["), "array").when(opened, "object").otherwise("lines")
    of: dict[str, list[str]] = {}
    for r in first.select("file", form.alias("form")).collect():  # one row a file
        of.setdefault(r["form"], []).append(unquote(r["file"]))
    read = lambda schema, **options: spark.read.schema(schema).options(mode="DROPMALFORMED", **options)
    rows = spark.createDataFrame([], fields)
    if "array" in of:
        rows = rows.unionByName(read(fields, multiLine=True).json(of["array"]))
    if "object" in of:
        rows = rows.unionByName(read(nested, multiLine=True).json(of["object"]).select(F.explode("locations").alias("x")).select("x.*"))
    if "lines" in of:
        rows = rows.unionByName(read(fields).json(of["lines"]))
    key = F.coalesce("location_key", "id", "name")
    return rows.select(key.alias("location_key"), F.coalesce("location_name", "name").alias("location_name"), "latitude", "longitude", "timezone").filter(key.isNotNull()).distinct()


def read_pollutants(spark: SparkSession, path: str) -> DataFrame:
    """pollutant_code, display_name, unit_default, aqi_timespan (may be null) of JSON lines."""
    rows = read_jsonl(spark, path, "pollutant_code string, display_name string, unit_default string, aqi_timespan string")
    return rows.filter("pollutant_code is not null")


def explode_payload(payload: DataFrame, measures: list[str]) -> DataFrame:
    """Hourly rows of a provider's arrays: the time axis from start (inclusive), end (exclusive) and interval_seconds."""
    axis = F.expr("transform(sequence(0L, unix_seconds(end) - unix_seconds(start) - interval_seconds, interval_seconds), s -> timestamp_seconds(unix_seconds(start) + s))")
    rest = [c for c in payload.columns if c not in {"start", "end", "interval_seconds", *measures}]
    rows = payload.filter("end > start").select(*rest, F.explode(F.arrays_zip(axis.alias("ts_utc"), *measures)).alias("x")).select(*rest, "x.*")
    clean = [F.when(~F.isnan(m), F.col(m)).alias(m) for m in measures]
    return rows.filter("ts_utc is not null").select(*rest, "ts_utc", F.to_date("ts_utc").alias("date_utc"), *clean)


def append(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("append").partitionBy(*by).parquet(path)


def overwrite(df: DataFrame, path: str, *by: str) -> None:
    """Replaces ``path``, which ``df`` may read: written beside it first, then swapped by two renames.

    Between the renames a reader finds no ``path``. If the second one fails the old state is put back; if the driver dies
    between them it lies beside ``path`` under ``.old-``.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    with settings(spark, **MICROS):
        df.write.partitionBy(*by).option("compression", "zstd").parquet(f"{path}.new-{mark}")
    fs, at = _at(spark, path)
    new, old = (_at(spark, f"{path}.{k}-{mark}")[1] for k in ("new", "old"))
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        fs.delete(new, True)
        raise OSError(f"{path} cannot be moved")
    if not fs.rename(new, at):
        if had and not fs.rename(old, at):
            raise OSError(f"{path} cannot be replaced; its old state is {old.toString()}")
        raise OSError(f"{path} cannot be replaced")
    fs.delete(old, True)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """location_key, ts_utc, label, prediction of a folder of CSV parts, in order of time."""
    return read_csv(spark, path, "location_key string, ts_utc timestamp, label double, prediction double").orderBy("ts_utc", "location_key")


def export_csv(spark: SparkSession, tables: dict[str, str], out: str) -> DataFrame:
    """Every parquet table (name to path) as CSV; (table, rows, status, error) tells how each went."""
    report = []
    for name, path in tables.items():
        try:
            seen = Observation()
            write_csv(spark.read.parquet(path).observe(seen, F.count(F.lit(1)).alias("rows")), f"{out.rstrip('/')}/{name}")
            report.append((name, counted(seen), "ok", None))
        except Exception as e:  # one bad table does not stop the others
            report.append((name, 0, "failed", str(e)[:500]))
    return spark.createDataFrame(report, "table string, rows long, status string, error string")
