"""Incremental history, refresh of days, ranks, bitmaps, bucketed tables, hot keys, pruning."""

import glob
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata import config, jobs
from strata.operators import dims, distincts, metrics
from strata.operators.ranking import with_rank
from strata.operators.sequence import dealt_by_range, with_neighbours
from strata.session import local_path, scratch_path
from strata.sources import feeds, tables


def changes(spark, rows):
    return spark.createDataFrame(rows, "user_id string, updated_at string, country string, loyalty_tier string").withColumn(
        "updated_at", F.to_timestamp("updated_at"))


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def uncoalesced(spark):
    """Ranges of small tables would be merged into one; as at scale, they stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_user_is_cut_into_even_ranges(spark, uncoalesced):
    """All rows belong to one user and nearly all to one second."""
    df = spark.range(4000).selectExpr("'u' AS k", "timestamp_micros(IF(id < 3900, 1704067200000000 + id, id * 1000000000000)) AS t", "id AS v")
    sizes = [r["count"] for r in dealt_by_range(df, ["k", "t"], "t_ranges").groupBy("k", "_b").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8
    got = with_neighbours(df, "k", "t", ["v"], plain=False).selectExpr("v", "_prev.v AS p", "_next.v AS n")
    w = Window.partitionBy("k").orderBy("t")
    assert rows_of(got) == rows_of(df.select("v", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n")))


def test_late_changes_are_spliced_in(spark):
    pick, log = random.Random(4), []
    for u in range(40):
        for _ in range(pick.randint(1, 9)):
            log.append((f"u{u}", f"2024-01-{pick.randint(1, 28):02d} 0{pick.randint(0, 9)}:00:00", pick.choice(["DE", "FR", None]), pick.choice(["gold", "silver"])))
    pick.shuffle(log)
    root = scratch_path(spark, "t_history")
    cuts = [0, 60, 61, 130, len(log)]
    for a, b in zip(cuts, cuts[1:]):
        jobs.splice_history(spark, changes(spark, log[a:b]), root)
    whole = dims.dim_user_scd2(changes(spark, log))
    assert rows_of(spark.read.parquet(f"{root}/user_history").select(*whole.columns)) == rows_of(whole)
    jobs.splice_history(spark, changes(spark, log[:50]), root)  # sent again
    assert rows_of(spark.read.parquet(f"{root}/user_history").select(*whole.columns)) == rows_of(whole)


def test_splicing_touches_the_folders_of_its_users(spark):
    root = scratch_path(spark, "t_touch")
    jobs.splice_history(spark, changes(spark, [(f"u{i}", "2024-01-01 00:00:00", "DE", "gold") for i in range(200)]), root)
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local_path(root)}/*/part=*/*.parquet")}
    before = files()
    (part,) = jobs.splice_history(spark, changes(spark, [("u7", "2023-12-01 00:00:00", "FR", "gold")]), root)
    kept = {f for f in before if f"/part={part}/" not in f}
    after = files()
    assert kept and {f: after.get(f) for f in kept} == {f: before[f] for f in kept}
    assert not {f for f in before if f"/part={part}/" in f} & set(after)


def feed(spark, rows):
    return spark.createDataFrame([(i, "u", "s", t, "view", "p", "c", "mobile", "DE", price, 1) for i, t, price in rows],
                                 "event_id string, user_id string, session_id string, event_time string, event_type string, product_id string, "
                                 "category string, device string, country string, price double, quantity int")


def test_refresh_replaces_only_its_days(spark):
    p, gold = jobs.SilverPaths(scratch_path(spark, "t_refresh")), scratch_path(spark, "t_refresh_gold")
    days = [("a", "2024-01-01T10:00:00", 1.0), ("b", "2024-01-02T10:00:00", 2.0), ("c", "2024-01-03T10:00:00", 3.0)]
    assert len(jobs.refresh_days(spark, feed(spark, days), p, config.TEST_AS_OF, config.TEST_CART_TYPES, gold)) == 3
    names = lambda d: sorted(glob.glob(f"{local_path(p.events)}/event_date={d}/*.parquet"))
    before = {d: names(f"2024-01-0{d}") for d in (1, 2, 3)}
    again = [("b", "2024-01-02T10:00:00", 5.0), ("c", "2024-01-03T10:00:00", -1.0)]
    assert jobs.refresh_days(spark, feed(spark, again), p, config.TEST_AS_OF, config.TEST_CART_TYPES, gold) == ["2024-01-02"]
    assert names("2024-01-01") == before[1] and names("2024-01-02") != before[2] and names("2024-01-03") == []
    assert sorted((r.event_id, r.price) for r in spark.read.parquet(p.events).collect()) == [("a", 1.0), ("b", 5.0)]
    kpis = spark.read.parquet(f"{gold}/daily_kpis_by_day")
    assert sorted((str(r.event_date), r.total_revenue) for r in kpis.collect()) == [("2024-01-01", 1.0), ("2024-01-02", 5.0)]


def test_ranks_with_ties_and_nulls(spark, uncoalesced):
    pick = random.Random(9)
    rows = [(i, pick.choice([1.0, 2.0, 3.5, None, 7.0, float(pick.randint(1, 500))]), pick.choice([None, 1, 2])) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, a double, b int")
    w = Window.orderBy(F.col("a").desc_nulls_last(), F.col("b").desc_nulls_last())
    assert rows_of(with_rank(df, ["a", "b"]).select("id", "rank")) == rows_of(df.select("id", F.rank().over(w).cast("long").alias("rank")))
    assert with_rank(df.limit(0), ["a"]).count() == 0


def test_bitmaps_of_new_days_join_the_stored_ones(spark):
    fact = spark.createDataFrame([(f"2024-01-{d:02d}", f"u{u}") for d, u in [(1, 1), (1, 1), (1, 2), (2, 1), (9, 70000), (9, 3), (31, 2)]] + [("2024-01-02", None)],
                                 "event_date string, user_id string").withColumn("event_date", F.to_date("event_date"))
    numbers = spark.createDataFrame([(f"u{u}", u) for u in (1, 2, 3, 70000, 32768)], "user_id string, user_no long")
    path = scratch_path(spark, "t_bitmaps")
    for days in ("< 5", ">= 5"):
        distincts.day_bitmaps(fact.where(f"day(event_date) {days}"), numbers).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    for period, start in distincts.PERIODS.items():
        want = fact.where("user_id IS NOT NULL").groupBy(F.expr(f"{start} AS starts")).agg(F.countDistinct("user_id").alias("members"))
        assert rows_of(distincts.distinct_members(stored, period).select("starts", "members")) == rows_of(want)


def test_bucketed_tables_join_without_shuffle(spark):
    root, db = scratch_path(spark, "t_bucketed"), "t_bucketed"
    tables.ensure_database(spark, db, root)
    tables.save_bucketed(spark.range(5000).selectExpr("id", "id % 50 AS k"), f"{db}.fact", "k", 4, f"{root}/fact")
    tables.save_bucketed(spark.range(50).selectExpr("id AS k", "id * 2 AS v"), f"{db}.dim", "k", 4, f"{root}/dim")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables.scan(spark, f"{db}.fact").groupBy("k").agg(F.count(F.lit(1)).alias("n")).join(tables.scan(spark, f"{db}.dim"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and joined.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_time_range_opens_its_days_only(spark):
    path = scratch_path(spark, "t_days")
    df = spark.range(240).selectExpr("id", "timestamp_seconds(1704067200 + id * 3600) AS event_time").withColumn("event_date", F.to_date("event_time"))
    feeds.write_table(df, path, partition_by=["event_date"])
    part = feeds.between(spark.read.parquet(path), "2024-01-03 06:00:00", "2024-01-05 00:00:00")
    assert part.count() == 42
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and len(part.inputFiles()) > 0
    assert part.select("event_date").distinct().count() == 2


def test_counts_come_from_the_write(spark):
    df, seen = metrics.observed(spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string"), ["a", "b"])
    df.write.mode("overwrite").parquet(scratch_path(spark, "t_metrics"))
    assert seen.get == {"rows": 3, "a": 1, "b": 2}
