"""Write PLANS.md: physical-plan facts for the headline and gold queries.

usage: python tools/plans.py [sf_dir]
For each query: shuffles by kind, join strategies, aggregates, windows / group limits, and the
scans' pushed filters and read schemas (from the plan Spark would run, before AQE re-planning).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

OPS = ["ReusedExchange", "AQEShuffleRead", "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobinPartitioning",
       "Exchange SinglePartition", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
       "Window ", "WindowGroupLimit", "TakeOrderedAndProject", "Expand", "Generate"]


def summarize(df) -> list[str]:
    df.collect()  # run it, so the plan below is AQE's final plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "== Initial Plan ==" in plan:  # AQE prints the final plan first, then the initial one
        plan = plan.split("== Initial Plan ==")[0]
    lines = []
    counts = {op.strip(): plan.count(op) for op in OPS if plan.count(op)}
    lines.append("operators: " + ", ".join(f"{k} x{v}" for k, v in counts.items()))
    scans = set()
    for m in re.finditer(r"FileScan parquet \[[^\]]*\][^\n]*?PartitionFilters: (\[[^\]]*\]), "
                         r"PushedFilters: (\[[^\]]*\])[^\n]*?ReadSchema: (struct<[^>]*>)", plan):
        part = f"partition filters {m.group(1)}; " if m.group(1) != "[]" else ""
        scans.add(f"scan: {part}pushed {m.group(2)}; reads {m.group(3)}")
    lines += sorted(scans)
    return lines


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from strata import config, jobs
    from strata.operators import clean as C
    from strata.operators import dims as D
    from strata.operators import facts as X
    from strata.operators import kpis as K
    from strata.operators import quality as Q
    from strata.operators.load import new_rows
    from strata.session import build_session, scratch_path
    from strata.sources import testdata as T

    spark = build_session("local[8]")
    cart, as_of = config.TEST_CART_TYPES, config.TEST_AS_OF
    raw, users = T.dirty_events(spark, sf_dir), T.user_changes(spark, sf_dir)
    clean = C.clean_events(raw, "intended", as_of, cart)
    wide_path = scratch_path(spark, "plans_wide")
    raw.repartition(24).write.parquet(wide_path)
    wide = spark.read.parquet(wide_path)
    largest = D.history_size(users)
    scd2 = D.dim_user_scd2(users, plain=largest <= D.DEFAULT_MAX_GROUP_ROWS)
    p = jobs.run_silver(spark, raw, users, scratch_path(spark, "plans_silver"), as_of, cart)
    star = jobs.load_star(spark, p)
    stored = spark.read.schema(star.fact.schema).parquet(p.fact)
    batch = X.build_fact(spark.read.parquet(p.events), star.users, star.products, star.dates)
    day = spark.read.parquet(p.events).where("event_date = DATE '2024-01-15'")
    queries = {
        "clean_events (intended)": clean,
        "daily_kpis (from clean)": K.daily_kpis(clean),
        "dim_user_scd2 (plain path)": scd2,
        "dim_user_scd2 (bucketed path)": D.dim_user_scd2(users, plain=False),
        "asof_join (range join)": D.asof_join(T.events_view(spark, sf_dir), scd2, range_join=True),
        "asof_join (bucketed carry)": D.asof_join(T.events_view(spark, sf_dir), scd2, range_join=False),
        "dim_product_first4": D.dim_product_first4(raw, as_of),
        "anomaly_report": Q.anomaly_report(raw, as_of, cart),
        "fact build (as-of user, product and date keys)": batch,
        "user load (anti-join on the stored change log)": new_rows(D.user_versions(users), spark.read.parquet(p.users), ["user_id", "updated_at"]),
        "fact load of one day (target pruned to its partitions)": new_rows(day, stored, ["event_id"], "event_date", unique=True),
        "cleaning on a wide scan (no spread)": C.clean_events(wide, "intended", as_of, cart),
        "daily_kpis as written (multiplicities)": K.daily_kpis_as_written(K.Fanned(
            C.clean_events(raw, "as_written", as_of, cart), D.dim_user_latest(T.user_feed(spark, sf_dir)), D.dim_product_first4(raw, as_of), D.dim_date(raw))),
        "gold daily_kpis (written fact)": K.daily_kpis(star.fact),
        "gold product_metrics (eager aggregation)": K.product_metrics(star),
        "gold top_purchasers (top 50)": K.top_purchasers(star),
        "gold best_month": K.best_month(star),
        "gold purchases on 2024-01-15 (partition pruning)": star.fact.where(
            "event_date = DATE '2024-01-15' AND event_type = 'purchase'").select("event_id", "price"),
    }
    out = ["# PLANS", "",
           f"Final physical plans (after AQE re-planning) at `{sf_dir}`, local[8], generated by",
           "`python tools/plans.py`. Counts are operator occurrences in the executed plan",
           "(`ReusedExchange` = a shuffle computed once and read again; `AQEShuffleRead` = partitions",
           "coalesced or skew-split at runtime); each distinct scan lists partition filters, pushed",
           "filters and the columns actually read.", ""]
    for name, df in queries.items():
        out.append(f"## {name}")
        out.append("")
        out += [f"- {line}" for line in summarize(df)]
        out.append("")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main(sys.argv)
