"""Catalog re-registration at a stable location, and randomized cleaning properties."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata import schemas
from strata.operators import clean, quality
from strata.session import scratch_path
from strata.sources import tables


def test_external_table_survives_reregistration(spark):
    root = scratch_path(spark, "t_db")
    db = "t_" + root.rsplit("-", 1)[-1]
    tables.ensure_database(spark, db, root)
    tables.ensure_table(spark, f"{db}.silver_date", schemas.DIM_DATE, f"{root}/silver_date")
    row = spark.createDataFrame([(dt.date(2024, 2, 3), 2024, 1, 2, "Feb", 5, 5, "Sat", 3, True)], schemas.DIM_DATE)
    tables.append_to_table(row, f"{db}.silver_date")
    spark.sql(f"DROP TABLE {db}.silver_date")  # external: the files stay
    tables.ensure_table(spark, f"{db}.silver_date", schemas.DIM_DATE, f"{root}/silver_date")
    assert tables.scan(spark, f"{db}.silver_date").count() == 1
    assert {r.col_name for r in tables.describe(spark, f"{db}.silver_date").collect()} >= {"full_date", "is_weekend"}


TYPES = st.sampled_from(["page_view", "product_view", "add_to_cart", "checkout", "purchase", " PURCHASE ", None])
CONTENT = st.tuples(st.sampled_from(["u1", "u2", None]), TYPES, st.sampled_from([None, -3, -1, 0, 1, 2]),
                    st.sampled_from(["p1", None]), st.sampled_from([None, -1.0, 0.0, 2.5]), st.integers(0, 40))
SCHEMA = ("event_id string, user_id string, session_id string, event_time timestamp, event_type string, "
          "product_id string, category string, device string, country string, price double, quantity int")


def _frame(spark, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(f"e{i}", u, "s1", base + dt.timedelta(days=d), t, p, "c", "mobile", "DE", price, q)
            for i, (u, t, q, p, price, d) in rows]
    return spark.createDataFrame(data, SCHEMA)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(CONTENT, min_size=1, max_size=15), st.lists(st.integers(0, 14), max_size=10))
def test_quarantine_partitions_and_clean_is_idempotent(spark, contents, repeats):
    """Duplicates in the feed are exact copies: an event id always carries the same content."""
    rows = list(enumerate(contents)) + [(i, contents[i]) for i in repeats if i < len(contents)]
    df = _frame(spark, rows)
    as_of = "2024-01-31 00:00:00"
    deduped = quality.dedupe(quality.normalize_strings(df), ["event_id"])
    kept, rejected = quality.split_quarantine(quality.quarantine(deduped, as_of))
    n = deduped.count()
    assert kept.count() + rejected.count() == n
    once = clean.clean_events(df, "intended", as_of)
    assert once.count() == kept.count()
    assert clean.clean_events(once, "intended", as_of).count() == once.count()
    assert once.select("event_id").distinct().count() == once.count()


def test_non_identical_duplicates_prefer_a_valid_copy(spark):
    """Same event id, different content: intended cleaning filters before it dedupes, so a valid
    copy wins; quarantine judges the deduped representative (the smallest row)."""
    df = _frame(spark, [(0, ("u1", "page_view", None, "p1", None, 0)), (0, ("u2", "page_view", None, "p1", 2.5, 0))])
    as_of = "2024-01-31 00:00:00"
    kept = clean.clean_events(df, "intended", as_of).collect()
    assert [(r.user_id, r.price) for r in kept] == [("u2", 2.5)]
    marked = quality.quarantine(quality.dedupe(df, ["event_id"]), as_of).collect()
    assert [r.reject_reason for r in marked] == ["non_positive_price"]
