"""Bronze: JSON feeds in, stamped lakehouse tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from strata import config, schemas


def to_feed_json(df: DataFrame) -> DataFrame:
    """Render typed times as the feed's ISO-8601 strings (microseconds, numeric offset)."""
    exprs = {f.name: F.date_format(f.name, config.FEED_TIME_FORMAT)
             for f in df.schema.fields if isinstance(f.dataType, TimestampType)}
    exprs.update({f.name: F.col(f.name).cast("string") for f in df.schema.fields
                  if f.dataType.typeName() == "date"})
    return df.withColumns(exprs) if exprs else df


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Land a feed as newline-delimited JSON (one file per task; no single-writer funnel)."""
    to_feed_json(df).write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema=schemas.CLICKSTREAM_FEED) -> DataFrame:
    """Batch JSON read with an explicit schema: no inference pass over the data, and a malformed
    line becomes an all-null row (PERMISSIVE) instead of failing the job."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


# ---- malformed lines ------------------------------------------------------------------------
#: Text of a line that does not fit the feed's schema, and whether and why a row is no event.
CORRUPT, REJECTED, REASON = "_corrupt_record", "rejected", "reject_reason"


def checked_schema(schema=schemas.CLICKSTREAM_FEED) -> StructType:
    """The feed's schema with a column for the text of lines that do not fit it."""
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def mark_lines(df: DataFrame, schema=schemas.CLICKSTREAM_FEED) -> DataFrame:
    """Why a line is no event: ``malformed`` (no JSON object), ``bad_field`` (a value of another type; the other fields
    are kept beside the text), ``empty`` (an object without a field of the feed)."""
    some = "(" + " OR ".join(f"`{f.name}` IS NOT NULL" for f in schema.fields) + ")"
    reason = f"CASE WHEN {CORRUPT} IS NOT NULL THEN if({some}, 'bad_field', 'malformed') WHEN NOT {some} THEN 'empty' END"
    return df.withColumn(REASON, F.expr(reason)).withColumn(REJECTED, F.col(REASON).isNotNull())


def ingest_checked(spark: SparkSession, landing: str, bronze: str, schema=schemas.CLICKSTREAM_FEED, load_ts: str | None = None) -> DataFrame:
    """Bronze job that keeps every line: one read and one write of stamped rows, events and rejected lines in
    folders of their own (:func:`events`, :func:`rejected_lines`). Returns the events."""
    lines = spark.read.schema(checked_schema(schema)).option("columnNameOfCorruptRecord", CORRUPT).json(landing)
    mark_lines(stamp(lines, load_ts), schema).write.mode("overwrite").partitionBy(REJECTED).parquet(bronze)
    return events(spark, bronze, schema)


def _bronze(spark: SparkSession, bronze: str, schema) -> DataFrame:
    stamps = [StructField("ingestion_ts", TimestampType()), StructField("ip_file_name", StringType())]
    return spark.read.schema(StructType([*checked_schema(schema).fields, *stamps, StructField(REASON, StringType()),
                                         StructField(REJECTED, BooleanType())])).parquet(bronze)


def events(spark: SparkSession, bronze: str, schema=schemas.CLICKSTREAM_FEED) -> DataFrame:
    """The stamped events of a checked bronze table; the scan reads their folder only."""
    return _bronze(spark, bronze, schema).where(f"{REJECTED} = false").drop(CORRUPT, REASON, REJECTED)


def rejected_lines(spark: SparkSession, bronze: str, schema=schemas.CLICKSTREAM_FEED) -> DataFrame:
    """The quarantine of a checked bronze table: the fields that could be read, the line's text (null for an empty
    object), its file, load time and the reason."""
    return _bronze(spark, bronze, schema).where(f"{REJECTED} = true").drop(REJECTED).withColumnRenamed(CORRUPT, "raw_line")


def stamp(df: DataFrame, load_ts: str | None = None) -> DataFrame:
    """B1: load time and source file of every row (``_metadata`` replaces input_file_name)."""
    ts = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    return df.withColumns({"ingestion_ts": ts, "ip_file_name": F.col("_metadata.file_path")})


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Full refresh (or append) of a lakehouse table by path. ``overwriteSchema`` is passed
    for table formats that version their schema; plain parquet ignores it."""
    if partition_by:  # AQE rebalance: hot values split, small outputs merged
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt)
    if mode == "overwrite" and fmt == "delta":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def refresh_partitions(df: DataFrame, path: str, column: str) -> None:
    """A7 for a part of a table: the partitions of ``column`` that ``df`` holds are replaced, all others keep their files."""
    df.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def between(df: DataFrame, start: str, end: str, time: str = "event_time", date: str = "event_date") -> DataFrame:
    """Rows of [start, end): the range of the time column also as a range of the date derived from it (A12), which is the
    partition column of stored events, so that the scan opens the days of the range only."""
    return df.where(f"`{time}` >= TIMESTAMP '{start}' AND `{time}` < TIMESTAMP '{end}' "
                    f"AND `{date}` >= to_date(TIMESTAMP '{start}') AND `{date}` <= to_date(TIMESTAMP '{end}')")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A3: load a lakehouse table by path."""
    return spark.read.format(fmt).load(path)


def ingest_batch(spark: SparkSession, landing: str, bronze: str, schema=schemas.CLICKSTREAM_FEED,
                 load_ts: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Bronze job for one feed: read JSON, stamp, overwrite the bronze table, return it read back."""
    write_table(stamp(read_json(spark, landing, schema), load_ts), bronze, "overwrite", fmt)
    return read_table(spark, bronze, fmt)


def feed_columns(schema=schemas.CLICKSTREAM_FEED) -> list[str]:
    return [f.name for f in schema.fields]
