"""Incremental landing: new files of a folder, merged into a table batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators import tables
from skyledger.schemas import Table
from skyledger.sources.store import Store


def land_new_files(store: Store, landing: str, table: Table, order: list, checkpoint: str, update: bool = True) -> StreamingQuery:
    """Merges what has arrived in ``landing`` since the last run and ends; of rows with one key the first by ``order`` wins,
    whichever came first.

    Only partitions that a batch has rows for are written. A batch that is run again after a failure gives the same table.
    """

    def merge(batch: DataFrame, _: int) -> None:
        own = Store(batch.sparkSession, store.root)
        own.merge(table, tables.latest(batch, list(table.keys), order), update, order if update else None)

    stream = store.spark.readStream.schema(table.schema).parquet(landing)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
