"""Dimension properties: SCD2 intervals, neighbour helper vs a plain window, keys, dates."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import dims
from strata.operators.keys import assign_surrogate_keys
from strata.operators.sequence import with_neighbours


def test_neighbours_equal_plain_window(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows, seen = [], set()
    for _ in range(600):
        k = rnd.choice(["a", "b", "c", "hot", "hot", "hot"])
        t = base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400))
        if (k, t) in seen:
            continue
        seen.add((k, t))
        rows.append((k, t, rnd.randint(0, 9)))
    df = spark.createDataFrame(rows, "k string, t timestamp, v int")
    got = with_neighbours(df, "k", "t", ["v"], plain=False).select(
        "k", "t", F.col("_prev")["t"].alias("pt"), F.col("_prev")["v"].alias("pv"), F.col("_next")["t"].alias("nt"))
    w = Window.partitionBy("k").orderBy("t")
    exp = df.select("k", "t", F.lag("t").over(w).alias("pt"), F.lag("v").over(w).alias("pv"),
                    F.lead("t").over(w).alias("nt"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def _feed(spark, rows):
    return spark.createDataFrame(rows, "user_id string, country string, loyalty_tier string, signup_date string, "
                                       "updated_at string")


def test_scd2_intervals_disjoint_one_current_and_collapsed(spark):
    rows = [
        ("u1", "DE", "bronze", "2024-01-01", "2024-01-01T00:00:00+00:00"),
        ("u1", "DE", "bronze", "2024-01-01", "2024-01-05T00:00:00+00:00"),  # no tracked change: merged
        ("u1", "FR", "bronze", "2024-01-01", "2024-01-09T00:00:00.5+00:00"),
        ("u1", "FR", "gold", "2024-01-01", "2024-02-01T00:00:00+00:00"),
        ("u2", "NL", "silver", "2024-01-03", "2024-01-03T10:00:00+00:00"),
    ]
    scd = dims.dim_user_scd2(_feed(spark, rows)).orderBy("user_id", "valid_from").collect()
    u1 = [r for r in scd if r.user_id == "u1"]
    assert [(r.country, r.loyalty_tier) for r in u1] == [("DE", "bronze"), ("FR", "bronze"), ("FR", "gold")]
    assert [r.is_current for r in u1] == [False, False, True]
    assert all(a.valid_to == b.valid_from for a, b in zip(u1, u1[1:]))
    assert u1[0].is_first and not u1[1].is_first
    assert sum(r.is_current for r in scd) == 2


import pytest


@pytest.mark.parametrize("range_join", [True, False])
def test_asof_picks_version_valid_at_event_time(spark, range_join):
    rows = [("u1", "DE", "bronze", "2024-01-01", "2024-01-02T00:00:00+00:00"),
            ("u1", "FR", "gold", "2024-01-01", "2024-01-10T00:00:00+00:00")]
    scd = dims.dim_user_scd2(_feed(spark, rows))
    ev = spark.createDataFrame([("e0", "u1", dt.datetime(2024, 1, 1)), ("e1", "u1", dt.datetime(2024, 1, 5)),
                                ("e2", "u1", dt.datetime(2024, 1, 10)), ("e3", "u9", dt.datetime(2024, 1, 5))],
                               "event_id string, user_id string, event_time timestamp")
    got = {r.event_id: r.version_country for r in dims.asof_join(ev, scd, range_join=range_join).collect()}
    assert got == {"e0": "DE", "e1": "DE", "e2": "FR", "e3": None}


def test_latest_flag_ties_are_all_current(spark):
    rows = [("u1", "DE", "b", "2024-01-01", "2024-01-01T01:00:00+00:00"),
            ("u1", "FR", "b", "2024-01-01", "2024-01-01T02:00:00+00:00"),
            ("u1", "NL", "b", "2024-01-01", "2024-01-01T02:00:00+00:00")]
    d = dims.dim_user_latest(_feed(spark, rows)).collect()
    # dedupe on (user, from, to) keeps one of the tied rows; the earlier version is not current
    flags = sorted((r.effective_to.hour, r.is_current) for r in d)
    assert flags == [(1, False), (2, True)]


def test_surrogate_keys_dense_unique_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).cast("string").alias("k"))
    keyed = assign_surrogate_keys(df, ["k"], "sk", start=100, num_partitions=7).collect()
    by_key = sorted(keyed, key=lambda r: r.k)
    assert [r.sk for r in by_key] == list(range(101, 5101))


def test_date_dimension_calendar(spark):
    ev = spark.createDataFrame([(dt.datetime(2024, 2, 3, 5),), (dt.datetime(2024, 2, 5, 1),), (None,)],
                               "event_time timestamp")
    d = {r.full_date: r for r in dims.dim_date(ev).collect()}
    sat, mon = d[dt.date(2024, 2, 3)], d[dt.date(2024, 2, 5)]
    assert (sat.weekday, sat.dayname, sat.is_weekend, sat.monthname) == (5, "Sat", True, "Feb")
    assert (mon.weekday, mon.weekyear, mon.is_weekend) == (0, 6, False)
    assert dt.date(1970, 1, 1) in d


def test_product_first4_keeps_four_times(spark):
    rows = [("p1", "c", dt.datetime(2024, 1, d)) for d in range(1, 8)] + [("p2", "c", dt.datetime(2024, 1, 1))]
    ev = spark.createDataFrame(rows, "product_id string, category string, event_time timestamp")
    out = dims.dim_product_first4(ev).collect()
    assert sorted(r.updated_ts.day for r in out if r.product_id == "p1") == [1, 2, 3, 4]
    assert len([r for r in out if r.product_id == "p2"]) == 1


def test_asof_strategies_agree(spark, sf_dir):
    """Range join and the bucketed carry-forward give identical results on the test tables."""
    from strata import config
    from strata.operators import clean
    from strata.sources import testdata as T

    ev = clean.clean_events(T.dirty_events(spark, sf_dir), "intended", config.TEST_AS_OF, config.TEST_CART_TYPES)
    scd = dims.dim_user_scd2(T.user_feed(spark, sf_dir))
    cols = ["event_id", "version_from", "version_country", "version_loyalty_tier"]
    a = dims.asof_join(ev, scd, range_join=True).select(*cols)
    b = dims.asof_join(ev, scd, range_join=False).select(*cols)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_null_user_has_a_latest_version(spark):
    feed = spark.createDataFrame([(None, "de", "2024-01-01", "2024-01-01T00:00:00"), (None, "fr", "2024-01-01", "2024-02-01T00:00:00")],
                                 "user_id string, country string, signup_date string, updated_at string")
    assert sorted((r.country, r.is_current) for r in dims.dim_user_latest(feed).collect()) == [("de", False), ("fr", True)]


def test_asof_strategies_agree_on_null_times_ties_and_single_versions(spark):
    import datetime as dt

    day = lambda d: dt.datetime(2024, 1, d)
    feed = spark.createDataFrame([("one", day(5), "DE", "gold"), ("two", day(5), "DE", "gold"), ("two", day(9), "FR", "gold")],
                                 "user_id string, updated_at timestamp, country string, loyalty_tier string")
    events = spark.createDataFrame([(i, u, t) for i, (u, t) in enumerate(
        [(u, t) for u in ("one", "two", "none", None) for t in (None, day(1), day(5), day(9), day(20))])], "event_id int, user_id string, event_time timestamp")
    scd2 = dims.dim_user_scd2(feed)
    by = [{r.event_id: r.version_country for r in dims.asof_join(events, scd2, range_join=p).collect()} for p in (True, False)]
    assert by[0] == by[1] and by[0][0] is None and by[0][1] == "DE" and by[0][8] == "FR"
