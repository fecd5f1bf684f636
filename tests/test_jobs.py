"""Production flow: silver job over written tables is idempotent and feeds gold correctly."""

from strata import config, jobs
from strata.operators import kpis
from strata.registry import REGISTRY
from strata.session import scratch_path
from strata.sources import testdata as T


def test_silver_job_idempotent_and_gold_matches_registry(spark, sf_dir):
    raw, users = T.dirty_events(spark, sf_dir), T.user_feed(spark, sf_dir)
    root = scratch_path(spark, "t_silver")
    p = jobs.run_silver(spark, raw, users, root, config.TEST_AS_OF, config.TEST_CART_TYPES)
    counts = {t: spark.read.parquet(getattr(p, t)).count() for t in ("users", "products", "dates", "fact")}
    jobs.run_silver(spark, raw, users, root, config.TEST_AS_OF, config.TEST_CART_TYPES)
    again = {t: spark.read.parquet(getattr(p, t)).count() for t in ("users", "products", "dates", "fact")}
    assert again == counts
    star = jobs.load_star(spark, p)
    assert star.fact.select("event_id").distinct().count() == counts["fact"]
    gold = sorted(map(tuple, kpis.daily_kpis(star.fact).collect()))
    reg = sorted(map(tuple, REGISTRY["daily_kpis"].run(spark, sf_dir).collect()))
    assert gold == reg
    out = jobs.run_gold(spark, p, scratch_path(spark, "t_gold"))
    assert set(out) >= {"daily_kpis", "funnel_metrics", "product_metrics", "top_purchasers", "session_funnel", "best_month"}
    names = jobs.register_tables(spark, p, "silver_t")
    assert names == ["silver_date", "silver_events", "silver_product", "silver_user"]
    assert spark.table("silver_t.silver_events").count() == counts["fact"]
    kept, rejected = spark.read.parquet(p.events), spark.read.parquet(p.rejected)
    assert rejected.join(kept, "event_id", "left_semi").count() == 0
    assert rejected.count() + kept.count() == raw.select("event_id").distinct().count()
