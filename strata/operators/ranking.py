"""Rank of every row in an order over the whole table (G4/G5), without a window over all rows in one task.

Rows are reduced to one per distinct order value with its count (combined map-side, so a value that many rows share costs one
row). The values are dealt by ranges, summed inside each range and across the ranges' totals, and each row gets its
value's rank by a join. Ties share a rank, and the next rank counts them, as ``rank()`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.sequence import dealt_by_range


def with_rank(df: DataFrame, order: list[str], rank_name: str = "rank") -> DataFrame:
    """``df`` with its rank from the greatest values of ``order`` down (nulls last)."""
    values = df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    names = values.columns
    values = dealt_by_range(values.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).select(
        *names, "_n"), names, "rank-values")
    down = [F.col(c).desc_nulls_last() for c in names]
    # Ranges go up with the values: what ranks before a value is the rest of its range above it, and all higher ranges.
    per_range = values.groupBy("_b").agg(F.sum("_n").alias("_n")).select(
        F.col("_b").alias("_r"), F.coalesce(F.sum("_n").over(Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("_n").over(Window.partitionBy("_b").orderBy(*down).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = values.withColumn("_inside", inside).join(F.broadcast(per_range), F.expr("_b = _r")).select(  # one row per range
        *names, (F.col("_inside") + F.col("_before") + 1).cast("long").alias(rank_name))
    same = F.expr(" AND ".join(f"`{c}` <=> _o{i}" for i, c in enumerate(order)))
    return df.join(ranked, same).drop(*names)
