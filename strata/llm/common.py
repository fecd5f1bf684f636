"""Helpers the operators of this subpackage share.

Lineage is cut only by tables written under the session's ``spark.checkpoint.dir``; a table that a
later round replaces is removed again through the Hadoop file system of its own path.
"""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Documents handled at once inside a task, and the most text bytes they may hold together.
SLICE_ROWS, SLICE_BYTES = 2000, 8 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it (where it is installed or
    shipped otherwise, the extra path does nothing)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


_HELD: dict[str, Callable[[], None]] = {}


def hold(name: str, forget: Callable[[], None]) -> None:
    """Called in a worker before an operator fills a cache: the caches of other operators are emptied, so that
    a worker which serves several operators, as in a pipeline, holds the cache of one at a time. What they took
    goes back to the system where the C library can give it back."""
    others = [n for n in _HELD if n != name]
    for other in others:
        _HELD.pop(other)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    _HELD[name] = forget


def written(df: DataFrame, name: str, parts: int | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` once under the shared checkpoint folder; the table read back and its path. ``parts``: the
    number of files, for tables known to be small against the session's number of shuffle partitions."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.coalesce(parts) if parts else df).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def parts_for(rows: int) -> int:
    """Files for a table of at most so many narrow rows."""
    return 1 + rows // 200_000


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`written` made."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` has not got (Spark compares them without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", rows: int = SLICE_ROWS,
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no slice holds more than ``rows`` rows or, when it has more than
    one row, much more than ``size`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (i - start >= rows or held + n > size):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The strings of a column, nulls as empty strings."""
    return [t or "" for t in batch.column(column).to_pylist()]


def per_batch(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
              column: str = "text") -> DataFrame:
    """Apply ``make`` to bounded slices of ``df``'s partitions."""

    def run(batches):
        for part in slices(batches, column):
            out = make(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


#: Odd multipliers of a 64-bit finalizer (fixed values).
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit keys: a bijection whose every output bit depends on every input bit."""
    s = np.uint64(33)
    x = (x ^ (x >> s)) * _M1
    x = (x ^ (x >> s)) * _M2
    return x ^ (x >> s)


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, component) of an undirected graph given as long pairs (a, b); component = least node.

    Each round every node hooks to its least neighbour, hooks are followed to their end by
    doubling, and the edges are contracted onto the roots; contracted edges shrink fast, so a few
    rounds suffice and all work is keyed joins and ``min`` aggregates (a node of any degree is
    combined map-side). Nulls and self-loops are dropped; an empty input gives an empty result.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges_now, edges_path = written(pairs, f"{name}-edges")
    parts = parts_for(2 * edges_now.count())  # no later table has more rows
    both = edges_now.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges_now.select(F.col("b").alias("node"), F.col("a").alias("other")))
    roots, roots_path = written(both.select("node").distinct().withColumn("component", F.col("node")), f"{name}-roots", parts)
    while not edges_now.isEmpty():
        both = edges_now.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges_now.select(F.col("b").alias("node"), F.col("a").alias("other")))
        hook, hook_path = written(
            both.groupBy("node").agg(F.min("other").alias("to")).select("node", F.least("node", "to").alias("to")),
            f"{name}-hook", parts)
        while True:
            nxt = hook.select(F.col("node").alias("to"), F.col("to").alias("further"))
            jumped, jumped_path = written(
                hook.join(nxt, "to").select("node", "to", "further"), f"{name}-jump", parts)
            moved = not jumped.where("further <> to").isEmpty()
            hook = jumped.select("node", F.col("further").alias("to"))
            remove(spark, hook_path)
            hook_path = jumped_path
            if not moved:
                break
        new_roots, new_roots_path = written(
            roots.join(hook.select(F.col("node").alias("component"), "to"), "component", "left")
            .select("node", F.coalesce("to", "component").alias("component")), f"{name}-roots", parts)
        new_edges, new_edges_path = written(
            edges_now.join(hook.select(F.col("node").alias("a"), F.col("to").alias("ra")), "a")
            .join(hook.select(F.col("node").alias("b"), F.col("to").alias("rb")), "b")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).where("a < b").distinct(),
            f"{name}-edges", parts)
        for path in (hook_path, roots_path, edges_path):
            remove(spark, path)
        roots, roots_path, edges_now, edges_path = new_roots, new_roots_path, new_edges, new_edges_path
    remove(spark, edges_path)
    return roots
