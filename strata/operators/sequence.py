"""Previous / next row within a key, without putting a whole key into one task.

``lag``/``lead`` over ``Window.partitionBy(key)`` sends every row of a key to one task; a key
holding a third of the data would then be sorted and buffered by a single core. Here the rows are dealt by
ranges of (key, order), whose edges Spark chooses by their number of rows, so a hot key is cut wherever its
rows lie, within a second as within a year:

1. the range number is stored with the rows (written once, so that a second look cannot deal them anew);
2. ``lag``/``lead`` inside each (key, range) -- a bounded group;
3. a partial+final aggregate gives the first and last row of every (key, range);
4. a window over those summaries (at most one row per range) carries the neighbour across the edges;
5. a join on (key, range) stitches the two. Steps 2 and 3 share one shuffle.

The result equals a plain window over the key for any data, because ranges are ordered like the order column.

When the largest key group is measured (one partial aggregate) and found under
``max_group_rows``, a plain window is used instead: one shuffle, and no task holds more than
that many rows. The measurement is the size check; the cut plan is the way beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

DEFAULT_MAX_GROUP_ROWS = 1_000_000


def largest_group(df: DataFrame, key: str) -> int:
    """Row count of the biggest key group (partial aggregate; one number reaches the driver)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0


def plain_window_is_safe(df: DataFrame, key: str, max_group_rows: int = DEFAULT_MAX_GROUP_ROWS) -> bool:
    return largest_group(df, key) <= max_group_rows


def dealt_by_range(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``df`` with the number ``_b`` of its range of ``columns``; ranges hold about equally many rows."""
    return materialize(df.repartitionByRange(*columns).withColumn("_b", F.spark_partition_id()), name)


def with_neighbours(df: DataFrame, key: str, order: str, payload: list[str], prev: bool = True,
                    next: bool = True, plain: bool | None = None, max_group_rows: int = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Adds ``_prev`` / ``_next`` struct columns (order column + payload of the neighbour row).

    ``order`` must be a non-null timestamp, unique within ``key`` (dedupe first). ``plain``
    forces the strategy; ``None`` measures the largest group against ``max_group_rows``.
    """
    fields = [order, *[p for p in payload if p != order]]
    if plain is None:
        plain = plain_window_is_safe(df, key, max_group_rows)
    if plain:
        struct = "struct(" + ", ".join(f"`{c}`" for c in fields) + ")"
        over = f"OVER (PARTITION BY `{key}` ORDER BY `{order}`)"
        cols = {}
        if prev:
            cols["_prev"] = F.expr(f"lag({struct}) {over}")
        if next:
            cols["_next"] = F.expr(f"lead({struct}) {over}")
        return df.withColumns(cols)
    base = dealt_by_range(df, [key, order], "sequence").withColumn("_s", F.struct(*[F.col(c) for c in fields]))
    w_in = Window.partitionBy(key, "_b").orderBy(order)
    if prev:
        base = base.withColumn("_prev_in", F.lag("_s").over(w_in))
    if next:
        base = base.withColumn("_next_in", F.lead("_s").over(w_in))
    # Struct order follows its first field (the order column), so min/max are first/last rows.
    summary = base.groupBy(key, "_b").agg(F.min("_s").alias("_first"), F.max("_s").alias("_last"))
    w_b = Window.partitionBy(key).orderBy("_b")
    cols = [F.col(key), F.col("_b")]
    if prev:
        cols.append(F.lag("_last").over(w_b).alias("_prev_b"))
    if next:
        cols.append(F.lead("_first").over(w_b).alias("_next_b"))
    edges = summary.select(*cols)
    out = base.join(edges, [key, "_b"], "left")
    if prev:
        out = out.withColumn("_prev", F.coalesce("_prev_in", "_prev_b")).drop("_prev_in", "_prev_b")
    if next:
        out = out.withColumn("_next", F.coalesce("_next_in", "_next_b")).drop("_next_in", "_next_b")
    return out.drop("_b", "_s")
