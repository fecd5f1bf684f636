"""Structured Streaming bronze ingest.

A file-source stream over the landing folder, stamped per row, written with a kept checkpoint
and ``availableNow`` (process everything present, in bounded micro-batches, then stop). The
checkpoint is never wiped: deleting it makes the source re-read every file while a file sink
silently skips batch ids it already committed. A replay uses a *new* checkpoint with an
idempotent ``foreachBatch`` sink instead, so it adds nothing that is already there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata import schemas
from strata.operators.load import append_new
from strata.sources import feeds

MAX_FILES_PER_TRIGGER = 1000


def read_stream(spark: SparkSession, landing: str, schema=schemas.CLICKSTREAM_FEED, fmt: str = "json",
                max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, glob: str | None = None) -> DataFrame:
    """H1: file-source micro-batches with a fixed schema (a malformed line -> all-null row). A
    micro-batch takes at most ``max_files_per_trigger`` files, so a full landing folder is worked off in
    batches of bounded size."""
    r = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(landing)


def stamp_stream(df: DataFrame) -> DataFrame:
    """H7: stateless enrichment -- load time and source file per row."""
    return df.withColumns({"ingestion_ts": F.current_timestamp(), "ip_file_name": F.input_file_name()})


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 output_mode: str = "append", partition_by: list[str] | None = None) -> StreamingQuery:
    """A5/A6 + H2/H4/H5: append, checkpointed, ``availableNow``."""
    w = df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.trigger(availableNow=True).start()


def console_preview(df: DataFrame, checkpoint: str, rows: int = 5) -> StreamingQuery:
    """A4: dry run to the console (append, once over what is available)."""
    return (df.writeStream.format("console").outputMode("append").option("numRows", str(rows))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_to_completion(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """H8: block until the availableNow run ends, however long it takes unless the caller sets a
    limit; surface a failure as an exception."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"stream {query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def ingest_stream(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                  schema=schemas.CLICKSTREAM_FEED, timeout_s: int | None = None,
                  max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Landing -> bronze in one availableNow run; returns the bronze table read back."""
    stream = read_stream(spark, landing, schema, max_files_per_trigger=max_files_per_trigger)
    q = write_stream(stamp_stream(stream), bronze, checkpoint)
    run_to_completion(q, timeout_s)
    return spark.read.parquet(bronze)


def ingest_stream_checked(spark: SparkSession, landing: str, bronze: str, checkpoint: str, schema=schemas.CLICKSTREAM_FEED,
                          timeout_s: int | None = None, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """As :func:`ingest_stream`, with malformed lines kept: one query, whose file sink commits events and rejected lines
    of a micro-batch together. Returns the events; ``feeds.rejected_lines`` has the rest."""
    lines = read_stream(spark, landing, feeds.checked_schema(schema), max_files_per_trigger=max_files_per_trigger)
    q = write_stream(feeds.mark_lines(stamp_stream(lines), schema), bronze, checkpoint, partition_by=[feeds.REJECTED])
    run_to_completion(q, timeout_s)
    return feeds.events(spark, bronze, schema)


def idempotent_sink(target: str, keys: list[str], partition_by: list[str] | None = None, source: str | None = None):
    """H6: ``foreachBatch`` function that appends only rows whose key is not yet in ``target``.
    A batch that is re-run (after a failure or from a fresh checkpoint) therefore adds nothing
    twice: exactly-once output on top of at-least-once delivery.

    With ``partition_by`` (e.g. an event date) the target is partitioned and each micro-batch
    reads only the keys of the partitions it touches, so its cost does not grow with the
    whole history of the target. ``source`` names the query's checkpoint: a micro-batch of it that the
    target's ledger has is skipped before anything is read."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, target, keys, partition_by=partition_by, batch_id=f"{source}#{batch_id}" if source else None)
    return sink


def replay_stream(spark: SparkSession, landing: str, target: str, checkpoint: str, keys: list[str],
                  schema=schemas.CLICKSTREAM_FEED, timeout_s: int | None = None,
                  partition_by: list[str] | None = None, derive=None,
                  max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> StreamingQuery:
    """Stream the landing folder into ``target`` through the idempotent sink. ``derive`` may add
    columns (such as the partition column) to each row before the sink."""
    stream = read_stream(spark, landing, schema, max_files_per_trigger=max_files_per_trigger)
    if derive is not None:
        stream = derive(stream)
    q = (stream.writeStream.foreachBatch(idempotent_sink(target, keys, partition_by, checkpoint))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    run_to_completion(q, timeout_s)
    return q
