"""Idempotent insert-only loads (E6) with surrogate keys continuing the target's sequence.

load = in-batch dedupe on the natural key -> left-anti join against a key-only read of the
target -> (surrogate keys going on from the ledger's greatest) -> append. Loading the same batch twice appends
nothing (a batch id that the ledger has is skipped before any read), and failures raise instead of being printed and
swallowed.
"""

from __future__ import annotations

import functools
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.keys import assign_surrogate_keys
from strata.operators.ledger import Ledger, stored_greatest_key
from strata.operators.quality import dedupe
from strata.session import materialized, remove_scratch


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds data files or partitions, asked of the path's own file system; anything
    but "not there" (no access, no network) raises. A folder with markers only holds no rows yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        return False
    return any(not s.getPath().getName().startswith((".", "_")) for s in store.listStatus(target))


def touched_partitions(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """``target`` reduced to the values of its partition column that ``batch`` holds (nulls included).
    The values become literals - one for each day of a batch - so the scan prunes its folders."""
    values = [r[0] for r in batch.select(column).distinct().collect()]
    known = [v for v in values if v is not None]
    keep = F.col(column).isin(known) if known else F.lit(False)
    return target.where(keep | F.col(column).isNull() if None in values else keep)


def new_rows(batch: DataFrame, target: DataFrame | None, keys: list[str],
             partition_column: str | None = None, unique: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (null-safe), one per key.

    ``unique``: the caller vouches for one row per key, so no dedupe runs. With ``partition_column``
    only the target's partitions that the batch touches are read."""
    if not unique:
        batch = dedupe(batch, keys)
    if target is None:
        return batch
    if partition_column:
        target = touched_partitions(target, batch, partition_column)
    existing = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    cond = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys])
    return batch.join(existing, cond, "left_anti")


def append_new(batch: DataFrame, path: str, keys: list[str], fmt: str = "parquet",
               key_name: str | None = None, key_order: list[str] | None = None,
               partition_by: list[str] | None = None, unique: bool = False, batch_id: str | None = None) -> int:
    """Append the batch's new rows to the table at ``path``; returns the number appended.

    Loads with a ``batch_id`` or surrogate keys are noted in the table's ledger: a batch that it has is skipped, and
    the next key is taken from it, without a look at the target's key column.

    The batch is written to scratch once where the load reads it twice (partition values, then rows), and
    removed afterwards. The target is read with the batch's own schema, so neither an empty table nor
    one with null partitions only needs inference. The anti-join reads the target's file list when the
    job is planned, so the append can read the table it writes to; the row count comes from ``observe``
    on the same write (one pass). Partitioned writes are rebalanced by AQE: a hot partition value is
    split across tasks and small outputs are merged, instead of one file per task and value.
    """
    spark = batch.sparkSession
    book = Ledger(spark, path) if key_name or batch_id else None
    if batch_id and book.loaded(batch_id):
        return 0
    target, scratch, start, partitions = None, None, None, None
    if table_exists(spark, path):
        schema = T.StructType([*batch.schema.fields, *([T.StructField(key_name, T.LongType())] if key_name else [])])
        target = spark.read.schema(schema).format(fmt).load(path)
        if partition_by:
            batch, scratch = materialized(batch, "load-batch")
    fresh = new_rows(batch, target, keys, partition_by[0] if partition_by else None, unique)
    if key_name:
        start = book.greatest_key()
        if start is None:
            start = stored_greatest_key(target, key_name) if target is not None else 0
        fresh = assign_surrogate_keys(fresh, key_order or keys, key_name, start)
    if book:
        batch_id = batch_id or uuid.uuid4().hex
        book.begin(batch_id, start)
    obs = Observation(f"append-{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if book and partition_by:
        metrics.append(F.expr(f"sort_array(collect_set(CAST(`{partition_by[0]}` AS STRING))) AS partitions"))
    observed = fresh.observe(obs, *metrics)
    if partition_by:
        observed = observed.hint("rebalance", *partition_by)
    w = observed.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    try:
        rows, partitions = int(obs.get["rows"]), obs.get.get("partitions")
    except (Py4JJavaError, KeyError):
        # AQE can prune an empty plan together with its metrics node; count it directly then
        # (the batch's file listing was taken before the write, so this sees the same rows).
        rows = fresh.count()
    if book:
        book.end(batch_id, rows, start + rows if key_name else None, list(partitions) if partitions is not None else None)
    if scratch:
        remove_scratch(spark, scratch)
    return rows
