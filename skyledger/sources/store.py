"""Tables of parquet folders under one root: reads, writes that touch only the partitions they change, and a log of changes.

One writer at a time. A write replaces whole partitions in one commit: if it fails before that, the table is as it was. The
commit itself is not atomic over several partitions. What a write is about to change is logged before the write, so a
reader of the log may find places that did not change, but misses none that did.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger import schemas
from skyledger.operators import tables
from skyledger.schemas import Table
from skyledger.sources import files

#: Partitions that are named one by one in a scan's filter; more become the range they span and a join.
NAMED_PARTITIONS = 1000
#: What may be broadcast: both bounds are measured on the written rows.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


class Partitions:
    """Distinct partition values: held by name up to NAMED_PARTITIONS, beyond that a frame and the range it spans."""

    def __init__(self, found: DataFrame) -> None:
        self.frame, self.by = found, found.columns
        few = found.limit(NAMED_PARTITIONS + 1).collect()
        self.named = {tuple(r) for r in few} if len(few) <= NAMED_PARTITIONS else None

    def __or__(self, other: Partitions) -> Partitions:
        both = Partitions.__new__(Partitions)
        both.frame, both.by = self.frame.unionByName(other.frame).distinct(), self.by
        both.named = self.named | other.named if self.named is not None and other.named is not None else None
        return both

    def within(self, rows: DataFrame) -> DataFrame:
        """``rows`` that lie there, told by literals, so that the scan is pruned; many partitions by their range and a join."""
        if self.named is not None:
            known = lambda i, c: F.col(c).isin(*{p[i] for p in self.named if p[i] is not None}) | (F.col(c).isNull() & F.lit(any(p[i] is None for p in self.named)))
            rows = rows.filter(reduce(lambda a, b: a & b, [known(i, c) for i, c in enumerate(self.by)]))
            if len(self.by) == 1:
                return rows
            frame = F.broadcast(self.frame.sparkSession.createDataFrame([*self.named], self.frame.schema))  # NAMED_PARTITIONS at most
        else:
            frame = self.frame
            span = frame.agg(*[f(c).alias(f"{n}_{c}") for c in self.by for n, f in (("a", F.min), ("b", F.max))]).first()
            rows = rows.filter(reduce(lambda a, b: a & b, [F.col(c).isNull() | tables.in_range(c, span[f"a_{c}"], span[f"b_{c}"]) for c in self.by]))
        return rows.alias("r").join(frame.alias("p"), _agree("r", "p", self.by), "left_semi")


@dataclass(frozen=True)
class Staged:
    """Rows that were computed once and written to scratch."""

    rows: DataFrame
    n: int
    small: bool
    _parts: dict[tuple[str, ...], Partitions] = field(default_factory=dict)

    def hinted(self, df: DataFrame) -> DataFrame:
        """``df``, made of these rows, for a join."""
        return F.broadcast(df) if self.small else df

    def partitions(self, by: Sequence[str]) -> Partitions:
        by = tuple(by)
        if by not in self._parts:
            self._parts[by] = Partitions(self.rows.select(*by).distinct())
        return self._parts[by]


@dataclass(frozen=True)
class Changes:
    """What changed in a table up to ``upto``: everything, or the values of its logged columns in ``where``."""

    upto: int
    everything: bool
    where: DataFrame | None


def _agree(a: str, b: str, columns: list[str]) -> Column:
    """Equal in all columns, nulls alike."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.layer}/{table.name}"

    def exists(self, table: Table) -> bool:
        return files.exists(self.spark, self.path(table))

    def read(self, table: Table) -> DataFrame:
        """The table, empty where it has not been written yet."""
        if not self.exists(table):
            return self.spark.createDataFrame([], table.schema)
        return self.spark.read.schema(table.schema).parquet(self.path(table)).select(*table.schema.names)

    def tables(self) -> DataFrame:
        """layer, table, path, written of every table of the registry."""
        rows = [(t.layer, t.name, self.path(t), self.exists(t)) for t in schemas.ALL]
        return self.spark.createDataFrame(rows, "layer string, table string, path string, written boolean")

    def register(self, prefix: str = "") -> list[str]:
        """Makes every table of the registry known to SQL as the temporary view prefix + layer_name; tables without rows are
        empty views. A view sees the files that lie there now: register again after a write."""
        names = []
        for t in schemas.ALL:
            names.append(f"{prefix}{t.layer}_{t.name}")
            self.read(t).createOrReplaceTempView(names[-1])
        return names

    def unregister(self, prefix: str = "") -> int:
        """Drops the views of ``register``; how many there were."""
        return sum(self.spark.catalog.dropTempView(f"{prefix}{t.layer}_{t.name}") for t in schemas.ALL)

    def create_all(self, drop: bool = False, dry_run: bool = False) -> DataFrame:
        """layer, table, action, ddl: makes the tables that are missing; with ``drop`` removes all first, facts before dimensions."""
        rows = []
        if drop:
            for t in reversed(schemas.ALL):
                if self.exists(t):
                    rows.append((t.layer, t.name, "drop", None))
                    if not dry_run:
                        self._log(t)
                        files.remove(self.spark, self.path(t))
        for t in schemas.ALL:
            if drop or not self.exists(t):
                rows.append((t.layer, t.name, "create", t.ddl))
                if not dry_run:
                    files.make_folder(self.spark, self.path(t))
        return self.spark.createDataFrame(rows, "layer string, table string, action string, ddl string")

    # Scratch

    @contextmanager
    def staging(self, df: DataFrame) -> Iterator[Staged]:
        """``df`` computed once; what reads it must end within the block."""
        path, seen = files.scratch(self.spark, "staged"), Observation()
        try:
            with files.settings(self.spark, **files.MICROS):
                df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(path)
            n = files.counted(seen)
            small = n <= BROADCAST_ROWS and files.size(self.spark, path) <= BROADCAST_BYTES
            yield Staged(self.spark.read.schema(df.schema).parquet(path), n, small)
        finally:
            files.remove(self.spark, path)

    def _conformed(self, table: Table, df: DataFrame) -> DataFrame:
        """In the table's columns. Files cannot tell an empty partition name from none: such a value is null from the start."""
        empty = {c: F.nullif(c, F.lit("")) for c in table.by if table.schema[c].dataType.typeName() == "string"}
        return tables.conform(df, table.schema).withColumns(empty)

    def matching(self, table: Table, found: Staged, how: str = "left_semi", rows: DataFrame | None = None) -> DataFrame:
        """Rows that agree with one of ``found`` in all its columns, nulls alike, or with ``left_anti`` all others in the same
        partitions; only partitions that are named there are read."""
        columns = found.rows.columns
        by = [c for c in table.by if c in columns]
        rows = self.read(table) if rows is None else rows
        rows = found.partitions(by).within(rows) if by else rows
        return rows.alias("r").join(found.hinted(found.rows).alias("f"), _agree("r", "f", columns), how)

    # The log of changes

    def _log_path(self, table: Table) -> str:
        return f"{self.root}/ops/changes/{table.layer}.{table.name}"

    def _versions(self, table: Table) -> dict[int, bool]:
        """Versions, and whether everything changed with each: the names of folders."""
        return {int(n.partition("-")[0]): n.endswith("-all") for n in files.names(self.spark, self._log_path(table)) if n[:1].isdigit()}

    def _log(self, table: Table, *rows: DataFrame) -> None:
        """Logs where ``rows`` lie as the next version; without any, that everything changed."""
        if not table.logged:
            return
        path = f"{self._log_path(table)}/{max(self._versions(table), default=0) + 1:012d}"
        if rows:
            reduce(DataFrame.unionByName, [r.select(*table.logged) for r in rows]).distinct().write.mode("overwrite").parquet(path)
        else:
            files.make_folder(self.spark, f"{path}-all")

    def changes(self, table: Table, since: int | None) -> Changes | None:
        """What changed after version ``since`` (None: from the beginning, that is everything); None where nothing did."""
        versions = self._versions(table)
        upto = max(versions, default=0)
        if since is None:
            return Changes(upto, True, None) if self.exists(table) else None
        later = [v for v in versions if v > since]
        if any(versions[v] for v in later):
            return Changes(upto, True, None)
        schema = StructType([table.schema[c] for c in table.logged])
        where = [f"{self._log_path(table)}/{v:012d}" for v in later]
        return Changes(upto, False, self.spark.read.schema(schema).parquet(*where).distinct()) if later else None

    def _frontier_path(self, stage: str, source: Table) -> str:
        return f"{self.root}/ops/frontiers/{stage}/{source.layer}.{source.name}"

    def frontier(self, stage: str, source: Table, rule: str = "") -> int | None:
        """The version of ``source`` that ``stage`` has worked in; None if never, or by another ``rule``."""
        found = [n.partition("-") for n in files.names(self.spark, self._frontier_path(stage, source))]
        return min((int(v) for v, _, _ in found), default=None) if all(r == rule for _, _, r in found) else None

    def advance(self, stage: str, source: Table, version: int, rule: str = "") -> None:
        """A frontier is the name of an empty folder: made before the old ones go, so the least one always holds."""
        path, name = self._frontier_path(stage, source), f"{version:012d}-{rule}"
        files.make_folder(self.spark, f"{path}/{name}")
        for old in files.names(self.spark, path):
            if old != name:
                files.remove(self.spark, f"{path}/{old}")

    # Writes

    def _write(self, df: DataFrame, table: Table, mode: str, old: DataFrame | None = None) -> int:
        """Rows of ``df`` written, in as few files a partition as their size allows, with rows of ``old``, which are not shuffled."""
        seen, spread = Observation(), lambda d: d.hint("rebalance", *table.by) if table.by else d
        out = spread(self._conformed(table, df).observe(seen, F.count(F.lit(1)).alias("rows")))
        out = out if old is None else out.unionByName(old)
        writer = out.sortWithinPartitions(*table.by, *table.keys).write.mode(mode).option("compression", "zstd")
        writer = writer.option("partitionOverwriteMode", "dynamic") if table.by and mode == "overwrite" else writer
        with files.settings(self.spark, **files.MICROS):
            writer.partitionBy(*table.by).parquet(self.path(table))
        return files.counted(seen)

    def append(self, table: Table, df: DataFrame) -> int:
        if not table.logged:
            return self._write(df, table, "append")
        with self.staging(self._conformed(table, df)) as new:
            self._log(table, new.rows)
            return self._write(new.rows, table, "append")

    def overwrite(self, table: Table, df: DataFrame) -> int:
        """The whole table becomes ``df``, which may read it."""
        rows = Observation()
        out = self._conformed(table, df).observe(rows, F.count(F.lit(1)).alias("rows"))
        self._log(table)
        files.overwrite((out.hint("rebalance", *table.by) if table.by else out).sortWithinPartitions(*table.by, *table.keys), self.path(table), *table.by)
        return files.counted(rows)

    def truncate(self, table: Table) -> int:
        """Rows removed; the table stays, empty."""
        rows = self.count(table)
        self._log(table)
        files.overwrite(self.spark.createDataFrame([], table.schema), self.path(table))
        return rows

    def _check(self, table: Table, new: Staged) -> None:
        """Keys must be unique, and partition columns must be what their keys say."""
        wrong = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.expr(e)) for c, e in table.derived], F.lit(False))
        groups = new.rows.select(*table.keys, wrong.cast("int").alias("_wrong")).groupBy(*table.keys).agg(F.count("*").alias("n"), F.max("_wrong").alias("wrong"))
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in table.keys])
        seen = groups.agg(F.max(F.when(known, F.col("n"))).alias("most"), F.max("wrong").alias("wrong")).first()
        if (seen["most"] or 0) > 1:
            raise ValueError(f"{table.name}: a key occurs more than once")
        if seen["wrong"]:
            raise ValueError(f"{table.name}: a row does not lie where its key says")

    def merge(self, table: Table, source: DataFrame, update: bool = True, order: list[Column] | None = None) -> int:
        """Upsert by the table's keys; rows written. With ``update`` off only rows of new keys are appended, and none is
        rewritten. With ``order`` the first of the old and the new row of a key stays. ``source`` is computed once; its keys
        must be unique, but null keys are equal to none.

        Only partitions that ``source`` names are read, and where these do not follow from the keys, also those that hold
        its keys now. A source that is small as measured is broadcast: then no row of the table is shuffled.
        """
        with self.staging(self._conformed(table, source)) as new:
            self._check(table, new)
            if not new.n:
                return 0
            keys = list(table.keys)
            rows = self.read(table)
            if table.by:
                parts = new.partitions(table.by)
                if not table.by_keys:
                    held = rows.alias("t").join(new.hinted(new.rows.select(*keys)).alias("s"), tables.same("t", "s", keys), "left_semi")
                    parts = parts | Partitions(held.select(*table.by).distinct())
                rows = parts.within(rows)
            if not update:
                rest = new.rows.alias("s").join(rows.select(*keys).alias("t"), tables.same("s", "t", keys), "left_anti")
                with self.staging(rest) as fresh:
                    if fresh.n:
                        self._log(table, fresh.rows)
                        self._write(fresh.rows, table, "append") if table.by else self.overwrite(table, self.read(table).unionByName(fresh.rows))
                    return fresh.n
            source = new.rows
            if order:
                held = rows.alias("t").join(new.hinted(source.select(*keys)).alias("s"), tables.same("t", "s", keys), "left_semi")
                both = held.withColumn("_old", F.lit(1)).unionByName(source.withColumn("_old", F.lit(0)))
                known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
                source = tables.latest(both.filter(known), keys, [*order, F.col("_old")]).unionByName(both.filter(~known)).drop("_old")
            kept = rows.alias("t").join(new.hinted(new.rows.select(*keys)).alias("s"), tables.same("t", "s", keys), "left_anti")
            self._log(table, *([rows, new.rows] if not table.by_keys else [new.rows]))
            if not table.by:
                self.overwrite(table, kept.unionByName(source))
            elif new.small:
                self._write(source, table, "overwrite", kept)
            else:
                self._write(source.unionByName(kept), table, "overwrite")
            return new.n

    def replace(self, table: Table, gone: Column | Staged, source: DataFrame) -> int:
        """Deletes rows for which ``gone`` holds, or that agree with one of it, and adds ``source``, which may read the table,
        in one write; rows added. Where ``source`` fails nothing is deleted."""
        with self.staging(self._conformed(table, source)) as new:
            self._rewrite(table, gone, new)
            return new.n

    def delete(self, table: Table, gone: Column | Staged) -> int:
        """Rows deleted. Partitions that lose all rows are removed."""
        return self._rewrite(table, gone, None) if self.exists(table) else 0

    def _rewrite(self, table: Table, gone: Column | Staged, new: Staged | None) -> int:
        """Partitions are counted, rewritten and told apart in tasks. Folders to remove come to the driver one by one."""
        rows, added = self.read(table), new.rows if new else self.spark.createDataFrame([], table.schema)
        by_column = isinstance(gone, Column)
        if not table.by:
            n = rows.filter(gone).count() if by_column else self.matching(table, gone).count()
            kept = tables.delete_where(rows, gone) if by_column else self.matching(table, gone, "left_anti")
            if n or (new and new.n):
                self.overwrite(table, kept.unionByName(added))
            return n
        own = list(table.by)
        if by_column:
            parts = Partitions(rows.filter(gone).select(*own).distinct())
        else:
            at = [c for c in own if c in gone.rows.columns]
            parts = gone.partitions(own) if at == own else Partitions(self.matching(table, gone).select(*own).distinct())
        agrees = (lambda d, how: d.filter(gone if how == "left_semi" else ~F.coalesce(gone, F.lit(False)))) if by_column else (lambda d, how: d.alias("r").join(gone.hinted(gone.rows).alias("f"), _agree("r", "f", gone.rows.columns), how))
        placed = self.spark.read.schema(table.schema).parquet(self.path(table)).select("*", F.col("_metadata.file_path").alias("_file")) if self.exists(table) else rows.withColumn("_file", F.lit(""))
        held = lambda how, name: agrees(parts.within(placed), how).groupBy(*own).agg(F.count("*").alias(name), F.max("_file").alias("_file"))
        # What each partition loses and keeps: one row a partition, on the driver where they are few.
        lost, left = held("left_semi", "lost"), held("left_anti", "left")
        census = lost.alias("a").join(left.alias("b"), _agree("a", "b", own), "left").select(*[F.col(f"a.{c}").alias(c) for c in own], "a.lost", F.coalesce("b.left", F.lit(0)).alias("left"), "a._file")
        with ExitStack() as stack:
            found = census.collect() if parts.named is not None else stack.enter_context(self.staging(census))
            n = sum(r["lost"] for r in found) if isinstance(found, list) else found.rows.agg(F.sum("lost")).first()[0] or 0
            if not n and not (new and new.n):
                return 0
            if table.logged:
                named = not by_column and set(table.logged) <= set(gone.rows.columns)
                self._log(table, gone.rows if named else agrees(parts.within(rows), "left_semi"), added)
            if new and new.n:
                parts = parts | new.partitions(own)
            keeps = any(r["left"] for r in found) if isinstance(found, list) else not found.rows.filter("left > 0").isEmpty()
            if keeps or (new and new.n):
                self._write(agrees(parts.within(rows), "left_anti").unionByName(added), table, "overwrite")
            filled = new.partitions(own) if new and new.n else None
            if isinstance(found, list):
                emptied = [r for r in found if not r["left"] and not (filled and filled.named is not None and tuple(r)[: len(own)] in filled.named)]
                if filled and filled.named is None and emptied:
                    emptied = self.spark.createDataFrame(emptied, census.schema).alias("h").join(filled.frame.alias("l"), _agree("h", "l", own), "left_anti").toLocalIterator()
            else:
                bare = found.rows.filter("left = 0")
                emptied = (bare.alias("h").join(filled.frame.alias("l"), _agree("h", "l", own), "left_anti") if filled else bare).toLocalIterator()
            for r in emptied:
                files.remove(self.spark, unquote(r["_file"]).rpartition("/")[0])
        return n

    # Counts and maxima from what the files say about themselves

    def sizes(self, table: Table, where: Column | None = None) -> DataFrame:
        """One row, n: rows by the footers of the files; ``where`` may name partition columns only. To be read within ``footers``."""
        rows = self.spark.read.schema(table.schema).parquet(self.path(table)) if self.exists(table) else self.spark.createDataFrame([], table.schema)
        return (rows.filter(where) if where is not None else rows).agg(F.count(F.lit(1)).alias("n"))

    @contextmanager
    def footers(self) -> Iterator[None]:
        """Within the block parquet is read by the source that answers counts and maxima from footers."""
        v1 = self.spark.conf.get("spark.sql.sources.useV1SourceList")
        rest = ",".join(s for s in v1.split(",") if s.strip() != "parquet")
        with files.settings(self.spark, spark__sql__sources__useV1SourceList=rest, spark__sql__parquet__aggregatePushdown="true"):
            yield

    def _days(self, table: Table) -> list[object]:
        """Values of the first partition column, from the names of folders, in order."""
        found = [n.partition("=") for n in files.names(self.spark, self.path(table)) if n.startswith(f"{table.by[0]}=")] if table.by else []
        days = self.spark.createDataFrame([(unquote(v),) for _, _, v in found if v != "__HIVE_DEFAULT_PARTITION__"], "v string")
        return sorted(r[0] for r in days.select(F.col("v").cast(table.schema[table.by[0]].dataType)).collect()) if found else []

    def first_day(self, table: Table) -> object | None:
        return next(iter(self._days(table)), None)

    def latest_day(self, table: Table) -> object | None:
        return next(reversed(self._days(table)), None)

    def count(self, table: Table, where: Column | None = None) -> int:
        with self.footers():
            return self.sizes(table, where).first()["n"] or 0

    def latest(self, table: Table) -> object | None:
        """The largest value of the table's clock: by the names of folders, or within the last of them where days follow from it."""
        day = self.latest_day(table)
        if table.clock in table.by[:1]:
            return day
        follows = day is not None and any(table.clock in sql for c, sql in table.derived if c == table.by[0])
        rows = self.read(table)
        return (rows.filter(F.col(table.by[0]) == F.lit(day)) if follows else rows).agg(F.max(table.clock)).first()[0]
