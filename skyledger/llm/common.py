"""Shared helpers of the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every word and line rule here.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def named(column: str) -> Column:
    """A column by its exact name, whatever signs that has."""
    return F.col("`" + column.replace("`", "``") + "`")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, wherever it lies on the driver."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Unset, a local one serves where all run in one
    process (tests); on a cluster that is an error, since executors would write where others cannot read."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends there, so a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of the bitmap that tells most rows without a partner.
BITS = 1 << 26


def maybe_in(df: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """``df`` with _maybe: false where its values of ``columns`` are not among those of ``keys``, else mostly true only where they
    are. The bitmap has BITS bits, however many keys there are; with more keys than bits it tells little."""
    place = F.pmod(F.xxhash64(*columns), F.lit(BITS))
    word, bit = F.shiftright(place, 6).cast("int"), F.pmod(place, F.lit(64)).cast("int")
    bits = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    found = df.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(materialize(bits, "bitmap")), "_word", "left")  # BITS / 64 rows at most
    return found.withColumn("_maybe", F.coalesce(F.expr("shiftright(_bits, _bit) & 1L") == 1, F.lit(False))).drop("_word", "_bit", "_bits")


def release(table: DataFrame) -> None:
    """Deletes a materialised table that nothing reads any more, before the application ends."""
    spark = table.sparkSession
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of jobs that have ended, which it does once the driver has collected its garbage.

    Between the steps of a long operator, so that its disk is that of its largest step and not the sum of all.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
