"""Edge rows with known outcomes (FIXTURES.md section 4) and cleaning properties."""

import datetime as dt

from pyspark.sql import functions as F

from strata import config
from strata.operators import clean, quality

FEED_CART = config.FEED_CART_TYPES

# (event_type, quantity, product_id) -> (as_written, notebook, intended-quantity, product-as-written)
ROWS = [
    (("page_view", None, "p"), (False, True, True, True)),
    (("add_to_cart", 2, "p"), (True, True, True, True)),
    (("add_to_cart", 0, "p"), (False, True, False, True)),
    (("add_to_cart", None, "p"), (False, False, False, True)),
    (("page_view", -1, "p"), (True, True, False, True)),
    ((None, 1, None), (True, True, True, False)),
    ((None, 0, "p"), (False, True, True, True)),
    (("purchase", 1, None), (True, True, True, False)),
    (("page_view", 1, None), (True, True, True, True)),
]


def _frame(spark):
    data = [(i, t, q, p) for i, ((t, q, p), _) in enumerate(ROWS)]
    return spark.createDataFrame(data, "i int, event_type string, quantity int, product_id string")


def _kept(df):
    return {r.i for r in df.select("i").collect()}


def test_quantity_rules_match_fixture_table(spark):
    df = _frame(spark)
    for col, rule in enumerate(["as_written", "notebook", "intended"]):
        expected = {i for i, (_, outcome) in enumerate(ROWS) if outcome[col]}
        assert _kept(quality.filter_quantity(df, rule, FEED_CART)) == expected, rule


def test_product_rule_as_written(spark):
    df = _frame(spark)
    expected = {i for i, (_, outcome) in enumerate(ROWS) if outcome[3]}
    assert _kept(quality.filter_product(df, "as_written", FEED_CART)) == expected


def test_positive_price_drops_zero_negative_null_garbage(spark):
    df = spark.createDataFrame([(s,) for s in ["1.5", "0", "-2", None, "abc"]], "price string")
    assert [r.price for r in quality.filter_positive_price(df).collect()] == ["1.5"]


def test_timestamps_parse_with_and_without_fraction(spark):
    df = spark.createDataFrame([("2026-09-26T21:10:09.101217+00:00",), ("2026-09-26T21:10:09+00:00",),
                                ("garbage",)], "event_time string")
    out = clean.as_timestamp(df, "event_time")
    got = [r[0] for r in df.select(out).collect()]
    assert got[0] == dt.datetime(2026, 9, 26, 21, 10, 9, 101217)
    assert got[1] == dt.datetime(2026, 9, 26, 21, 10, 9)
    assert got[2] is None


def test_dedupe_is_deterministic_and_needs_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v int")
    assert sorted(tuple(r) for r in quality.dedupe(df, ["k"]).collect()) == [("a", 1), ("b", 3)]
    import pytest

    with pytest.raises(ValueError):
        quality.dedupe(df, [])


def test_normalize_intended_vs_as_written(spark):
    df = spark.createDataFrame([(" PURCHASE ", " Mobile", "Germany", "2024-01-01T00:00:00+00:00")],
                               "event_type string, device string, country string, event_time string")
    iw = quality.normalize_strings(df, "intended").first()
    assert (iw.event_type, iw.device, iw.country) == ("purchase", "mobile", "Germany")
    aw = quality.normalize_strings(df, "as_written").first()
    assert aw.country == "germany" and aw.event_time == "2024-01-01T00:00:00+00:00"  # T survives


def test_clean_is_idempotent_and_quarantine_partitions_input(spark, sf_dir):
    from strata.sources import testdata

    raw = testdata.dirty_events(spark, sf_dir)
    once = clean.clean_events(raw, "intended", config.TEST_AS_OF, config.TEST_CART_TYPES)
    twice = clean.clean_events(once, "intended", config.TEST_AS_OF, config.TEST_CART_TYPES)
    assert once.count() == twice.count()
    deduped = quality.dedupe(quality.normalize_strings(raw), ["event_id"])
    marked = quality.quarantine(deduped, config.TEST_AS_OF, config.TEST_CART_TYPES)
    kept, rejected = quality.split_quarantine(marked)
    assert kept.count() + rejected.count() == deduped.count()
    assert kept.count() == once.count()


def test_anomaly_report_reproduces_injected_counts(spark, sf_dir):
    """The overlay's classes are disjoint and chosen by modulus, so the expected counts follow
    from the numeric event ids alone."""
    from strata.sources import testdata as T

    ids = [r.event_id for r in spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id").collect()]
    report = quality.anomaly_report(T.dirty_events(spark, sf_dir), config.TEST_AS_OF, config.TEST_CART_TYPES).first()
    base = T.events_view(spark, sf_dir, keep_numeric_id=True).withColumn("_cls", T.anomaly_class())
    classes = {r._cls: r.n for r in base.groupBy("_cls").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert report.total_rows == len(ids) + classes.get("duplicate", 0)
    assert report.duplicate_events == classes.get("duplicate", 0)
    assert report.null_user_or_product == classes.get("null_user", 0) + classes.get("null_product", 0)
    assert report.null_device_country_category == classes.get("null_attribute", 0)
    assert report.dirty_strings == classes.get("dirty_type", 0)
    assert report.future_event_time == classes.get("future", 0)
    assert report.invalid_quantity == classes.get("bad_quantity", 0)
