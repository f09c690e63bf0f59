"""Incremental ingest of a landing folder into a current-state table.

Re-aims "rename consumed files / skip processed files" as a Structured
Streaming file source with a checkpoint: each new file is consumed exactly
once from the source's point of view, and every micro-batch is merged
(A2) into a keyed table, of which only the folders of changed keys are written.
``foreachBatch`` is at-least-once; the merge is idempotent, so a replayed
batch finds nothing changed.

Two rules of precedence: by default a later batch beats what is stored, and inside a
batch the drop's date decides, then ``order``.  With ``stateful`` the drop's date and
``order`` decide over all batches: Spark's streaming state holds the last row
per key, so a drop that lands late doesn't undo a newer one, and the table is what one
batch over all files would give."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldops.operators.state import latest_by_key
from fieldops.sources.io import arrival_key, drop_name, table_exists
from fieldops.sources.keyed import KeyedTable, adopted

FOLDERS = 64  # of a table that names no parts


def upsert_batch(batch: DataFrame, epoch_id: int, root: str, name: str, key: Sequence[str], parts: str) -> None:
    """One micro-batch (one row per key): merge the keys whose row changes into the stored
    table and publish a new version; the version before stays for its readers, older ones go.
    Only a table that was never published counts as a first load; a stored one that
    cannot be read stops the batch."""
    spark = batch.sparkSession
    if not table_exists(spark, root, name):
        KeyedTable.create(batch, root, name, key, parts).publish()
        return
    stored = adopted(spark, root, name, key, parts)
    merged, written = stored.merged(stored.changes(batch))
    if written:
        merged.publish()
        merged.expire(but=stored)


def last_rows(stream: DataFrame, key: Sequence[str], order: Sequence[str], rank: str) -> DataFrame:
    """The last row per key by (``rank``, ``order``), without ``rank``; of a stream, with its
    state, the keys that a batch brings (update mode)."""
    return latest_by_key(stream, key, [rank, *order], [rank])


def ingest_stream(spark: SparkSession, source: str, schema: StructType, key: Sequence[str], order: Sequence[str],
                  root: str, name: str, checkpoint: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, stateful: bool = False, parts: str | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream over ``source``; returns the query
    (call ``awaitTermination()``).  The state table is read with
    ``sources.io.read_table(spark, root, name)``.  ``parts``: see ``KeyedTable``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    key, dealt = list(key), parts or f"pmod(xxhash64({', '.join(f'`{k}`' for k in key)}), {FOLDERS})"
    stream = reader.load(source).withColumn("_drop_rank", arrival_key(drop_name()))
    if stateful:
        rows, mode = last_rows(stream, key, order, "_drop_rank"), "update"
        take = lambda df, epoch: upsert_batch(df, epoch, root, name, key, dealt)
    else:
        rows, mode = stream, "append"
        take = lambda df, epoch: upsert_batch(last_rows(df, key, order, "_drop_rank"), epoch, root, name, key, dealt)
    return (rows.writeStream
            .foreachBatch(take)
            .outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
