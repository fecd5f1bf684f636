"""Exact distinct counts that add up (F1, F2, F5): bitmaps over dense numbers, one set per day.

``count(DISTINCT user)`` of a week is no sum of its days' counts, so it needs the fact again. A day's users as bitmaps over
dense user numbers (32,768 users in 4 KB) are stored once; any period's count is the number of bits of its days' bitmaps
laid over each other. Numbers go on from the greatest, so stored days stay right when users are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERIODS = {"day": "event_date", "week": "CAST(date_trunc('WEEK', event_date) AS DATE)", "month": "CAST(date_trunc('MONTH', event_date) AS DATE)"}


def day_bitmaps(fact: DataFrame, numbers: DataFrame, member: str = "user_id", number: str = "user_no") -> DataFrame:
    """event_date, part, members: one bitmap per day and 32,768 numbers. ``numbers``: one row per ``member`` with its number
    from 1. A day's members are reduced to distinct pairs before they meet their numbers."""
    pairs = fact.select("event_date", F.col(member).alias("_m")).where("_m IS NOT NULL").distinct()
    known = numbers.select(F.col(member).alias("_k"), F.col(number).cast("long").alias("_no"))
    return pairs.join(known, F.expr("_m = _k")).groupBy("event_date", F.expr("bitmap_bucket_number(_no) AS part")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(_no)) AS members"))


def distinct_members(bitmaps: DataFrame, period: str) -> DataFrame:
    """period, starts, members: the exact number of distinct members of every day, week or month with any."""
    merged = bitmaps.groupBy(F.expr(f"{PERIODS[period]} AS starts"), "part").agg(F.expr("bitmap_or_agg(members) AS members"))
    return merged.groupBy("starts").agg(F.expr("CAST(sum(bitmap_count(members)) AS BIGINT) AS members")).selectExpr(
        f"'{period}' AS period", "starts", "members")
