"""Physical plan expectations: group limit, pushed filters, pruned scans, no single-key windows."""

from strata.operators import dims, kpis, quality
from strata.plans.inspect import exchanges, pushed_filters
from strata.plans.inspect import physical_plan as _plan
from strata.sources import testdata


def test_first4_uses_window_group_limit(spark, sf_dir):
    plan = _plan(dims.dim_product_first4(testdata.dirty_events(spark, sf_dir)))
    lines = plan.splitlines()
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l)
    final = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Final" in l)
    between = lines[final:partial]
    assert any("Exchange hashpartitioning(product_id" in l for l in between)  # limit applied map-side


def test_filters_and_pruning_reach_the_scan(spark, sf_dir):
    changes = testdata.user_changes(spark, sf_dir)
    assert any("EqualTo(event_type,signup)" in f for f in pushed_filters(changes))
    plan = _plan(changes)
    assert "struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan and "value" not in plan
    assert plan.count("events.parquet") == 1  # one scan of the events


def test_as_written_kpis_make_no_fan_out(spark, sf_dir):
    from strata.registry import Inputs

    x = Inputs(spark, sf_dir)
    for make in (kpis.daily_kpis_as_written, kpis.funnel_metrics_as_written, kpis.product_metrics_as_written, kpis.top_purchasers_as_written):
        rows = make(x.fanned)
        assert "NestedLoop" not in _plan(rows) and "Cartesian" not in _plan(rows)
    assert x.fanned.events.count() == x.clean("as_written").count()  # one row for each event


def test_first4_needs_no_distinct(spark, sf_dir):
    assert exchanges(dims.dim_product_first4(testdata.dirty_events(spark, sf_dir))) <= 3


def test_results_are_ordered_as_promised(spark, sf_dir):
    from strata.registry import REGISTRY

    funnel = REGISTRY["funnel_metrics"].run(spark, sf_dir).collect()
    assert [(-r.total_events, r.event_type) for r in funnel] == sorted((-r.total_events, r.event_type) for r in funnel)
    top = REGISTRY["top_purchasers"].run(spark, sf_dir).collect()
    assert [(-r.purchase_totals, r.user_id) for r in top] == sorted((-r.purchase_totals, r.user_id) for r in top)
    products = REGISTRY["product_metrics"].run(spark, sf_dir).collect()
    keys = [(-r.revenue, -r.total_interactions, r.product_id) for r in products]
    assert keys == sorted(keys)


def test_dedupe_is_an_aggregate_not_a_window(spark, sf_dir):
    plan = _plan(quality.dedupe(testdata.dirty_events(spark, sf_dir), ["event_id"]))
    assert "Window" not in plan and "Aggregate" in plan


def test_latest_flag_has_no_window(spark, sf_dir):
    assert "Window " not in _plan(dims.dim_user_latest(testdata.user_feed(spark, sf_dir)))


def test_top_purchasers_is_take_ordered(spark, sf_dir):
    from strata.registry import Inputs

    x = Inputs(spark, sf_dir)
    plan = _plan(kpis.top_purchasers(x.star(), limit=50))
    assert "TakeOrderedAndProject" in plan or "limit=50" in plan.lower()


def test_spread_only_when_scan_is_narrow(spark):
    wide = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert testdata.spread(wide) is wide  # at cluster scale scans already have many splits
    narrow = spark.range(0, 1000, numPartitions=1)
    assert "Exchange hashpartitioning" in _plan(testdata.spread(narrow, by="CAST(id AS STRING)"))
    assert "RoundRobinPartitioning" in _plan(testdata.spread(narrow))


def test_clean_dedupe_reuses_the_spread_partitioning(spark, sf_dir):
    from strata import config
    from strata.operators import clean

    plan = _plan(clean.clean_events(testdata.dirty_events(spark, sf_dir), "intended", config.TEST_AS_OF,
                                    config.TEST_CART_TYPES))
    assert plan.count("Exchange hashpartitioning") == 1  # the spread; the dedupe adds none
