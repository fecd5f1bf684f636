"""Production flow: bronze -> silver -> gold over written tables.

Each step reads what the previous step wrote, so lineage is cut at every layer boundary (a lost
executor only recomputes from the last written table), and the planner sees real file sizes
when it decides which dimension joins can be broadcast.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config
from strata.functions.columns import as_timestamp
from strata.operators import clean as C
from strata.operators import dims as D
from strata.operators import facts as X
from strata.operators import kpis as K
from strata.operators import quality as Q
from strata.operators.load import append_new, table_exists
from strata.session import materialized, remove_scratch
from strata.sources import feeds, tables


@dataclass
class SilverPaths:
    root: str

    @property
    def events(self) -> str:
        return f"{self.root}/silver_events"

    @property
    def users(self) -> str:
        return f"{self.root}/silver_user"

    @property
    def products(self) -> str:
        return f"{self.root}/silver_product"

    @property
    def dates(self) -> str:
        return f"{self.root}/silver_date"

    @property
    def rejected(self) -> str:
        return f"{self.root}/quarantine_events"

    @property
    def fact(self) -> str:
        return f"{self.root}/silver_fact"


def run_bronze(spark: SparkSession, landing: str, bronze: str, load_ts: str | None = None) -> DataFrame:
    """Landing JSON -> stamped bronze table (full refresh); lines that are no events are kept beside it."""
    return feeds.ingest_checked(spark, landing, bronze, load_ts=load_ts)


def _concurrently(*steps) -> list:
    """Run independent Spark jobs from driver threads: the scheduler interleaves their tasks,
    so small jobs fill cores (or executors) the others leave idle. Errors propagate."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def run_silver(spark: SparkSession, bronze_events: DataFrame, user_feed: DataFrame, root: str,
               as_of: str, cart_types=config.FEED_CART_TYPES) -> SilverPaths:
    """Clean events, load the dimensions idempotently, then build and load the fact from the
    dimensions as written (so surrogate keys are the stored ones). Independent loads run as
    concurrent jobs: silver events with user versions, then products with dates."""
    p = SilverPaths(root)
    clean = C.clean_events(bronze_events, "intended", as_of, cart_types)
    _concurrently(
        lambda: feeds.write_table(clean, p.events, "overwrite", partition_by=["event_date"]),
        lambda: feeds.write_table(rejected_events(bronze_events, as_of, cart_types), p.rejected, "overwrite"),
        lambda: append_new(D.user_versions(user_feed), p.users, ["user_id", "updated_at"], key_name="user_sk"))
    clean = spark.read.parquet(p.events)
    _concurrently(
        lambda: load_products(D.dim_product(clean), p.products),
        lambda: append_new(D.dim_date(clean), p.dates, ["full_date"], key_name="date_key"))
    versions = spark.read.parquet(p.users)
    largest = D.history_size(versions)
    star = load_star(spark, p, with_fact=False, history=largest)
    fact = X.build_fact(clean, star.users, star.products, star.dates, "intended",
                        range_join=largest <= D.MAX_VERSIONS_FOR_RANGE_JOIN)
    # one fact row per clean event (deduped on event_id upstream): no second in-batch dedupe
    append_new(fact, p.fact, ["event_id"], key_name="event_sk", partition_by=["event_date"], unique=True)
    return p


def rejected_events(bronze_events: DataFrame, as_of: str, cart_types=config.FEED_CART_TYPES) -> DataFrame:
    """One row for each event that cleaning drops, with its reasons. An event with a valid copy is not
    rejected, so copies are judged before they are merged."""
    rows = Q.normalize_strings(bronze_events, "intended")
    rows = rows.withColumn("event_time", as_timestamp(rows, "event_time"))
    marked = Q.quarantine(rows, as_of, cart_types)
    per = marked.groupBy("event_id").agg(F.min(F.struct(
        F.col("reject_reason").isNotNull().alias("rejected"), *[F.col(c) for c in marked.columns if c != "event_id"])).alias("first"))
    return per.where("first.rejected").select("event_id", *[f"first.{c}" for c in marked.columns if c != "event_id"])


def refresh_days(spark: SparkSession, bronze_events: DataFrame, p: SilverPaths, as_of: str, cart_types=config.FEED_CART_TYPES,
                 gold: str | None = None) -> list[str]:
    """Clean the days that ``bronze_events`` holds anew: their partitions of silver events are replaced, and with ``gold``
    their rows of the daily KPIs, a table by day. Returns the days."""
    clean, scratch = materialized(C.clean_events(bronze_events, "intended", as_of, cart_types), "refresh")
    days = [str(r[0]) for r in clean.select("event_date").distinct().collect()]  # one row per day
    sent = bronze_events.select(F.to_date(as_timestamp(bronze_events, "event_time")).alias("d")).where("d IS NOT NULL").distinct()
    feeds.refresh_partitions(clean, p.events, "event_date")
    kpis = f"{gold}/daily_kpis_by_day" if gold else None
    if kpis:
        feeds.refresh_partitions(K.daily_kpis(clean), kpis, "event_date")
    for day in {str(r[0]) for r in sent.collect()} - set(days):  # sent again, and no event of the day is valid any more
        for table in filter(None, (p.events, kpis)):
            remove_scratch(spark, f"{table}/event_date={day}")
    remove_scratch(spark, scratch)
    return sorted(days)


def bucket_star(spark: SparkSession, p: SilverPaths, database: str, buckets: int) -> None:
    """The fact and its dimensions as catalog tables bucketed by the keys they meet on (E1, E5): ``fact_by_product`` with
    ``products``, ``fact_by_user`` with ``users``. Joins and totals by a key then need no shuffle of the fact."""
    tables.ensure_database(spark, database, f"{p.root}/_bucketed")
    star = load_star(spark, p)
    for name, df, key in (("fact_by_product", star.fact, "product_sk"), ("products", star.products, "product_sk"),
                          ("fact_by_user", star.fact, "user_sk"), ("users", star.users, "user_sk")):
        tables.save_bucketed(df, f"{database}.{name}", key, buckets, f"{p.root}/_bucketed/{name}")


#: Folders of the user history; a change batch rewrites those of its users only.
HISTORY_PARTS = 64
_PART = f"CAST(pmod(xxhash64(user_id), {HISTORY_PARTS}) AS INT)"


def splice_history(spark: SparkSession, changes: DataFrame, root: str) -> list[int]:
    """Put a batch of user changes, late ones included, into the stored history (D2): the change log and the type-2
    intervals made of it lie in folders by user; only folders with users of the batch are read and replaced, and in them
    only those users' intervals are worked out. Returns the folders."""
    log, history = f"{root}/user_log", f"{root}/user_history"
    batch, scratch = materialized(D.user_versions(changes).withColumn("part", F.expr(_PART)), "history-batch")
    parts = [r[0] for r in batch.select("part").distinct().collect()]  # at most HISTORY_PARTS
    touched = batch.select("user_id").distinct()
    versions, others = batch, None
    if table_exists(spark, log):
        here = F.col("part").isin(parts)
        stored = spark.read.schema(batch.schema).parquet(log).where(here)
        versions = Q.dedupe(stored.unionByName(batch), ["user_id", "updated_at"])
        kept = spark.read.parquet(history).where(here)
        others = kept.join(touched, "user_id", "left_anti")
    versions, held = materialized(versions, "history-versions")
    intervals = D.dim_user_scd2(versions.join(touched, "user_id", "left_semi")).withColumn("part", F.expr(_PART))
    if others is not None:
        intervals = intervals.unionByName(others.select(*intervals.columns))
    intervals, made = materialized(intervals, "history-intervals")
    feeds.refresh_partitions(intervals, history, "part")
    feeds.refresh_partitions(versions, log, "part")
    for path in (scratch, held, made):
        remove_scratch(spark, path)
    return sorted(parts)


def load_products(products: DataFrame, path: str) -> int:
    """Append a version of every product that is new or whose category differs from its latest stored one."""
    spark = products.sparkSession
    if table_exists(spark, path):
        stored = latest_products(spark.read.parquet(path)).selectExpr("product_id AS _id", "category AS _category", "true AS _known")
        products = products.join(stored, F.expr("product_id <=> _id"), "left").where(
            "_known IS NULL OR NOT (category <=> _category)").select(*products.columns)
    return append_new(products, path, ["product_id", "updated_ts"], key_name="product_sk")


def latest_products(versions: DataFrame) -> DataFrame:
    """The current version of each product."""
    rest = [c for c in versions.columns if c not in ("product_id", "updated_ts", "product_sk")]
    per = versions.groupBy("product_id").agg(F.max(F.struct("updated_ts", "product_sk", *rest)).alias("last"))
    return per.select("product_id", *[f"last.{c}" for c in versions.columns if c != "product_id"])


def register_tables(spark: SparkSession, p: SilverPaths, database: str) -> list[str]:
    """The silver tables as external tables of ``database`` at their locations."""
    tables.ensure_database(spark, database, f"{p.root}/_database")
    names = {"silver_user": p.users, "silver_product": p.products, "silver_date": p.dates, "silver_events": p.fact}
    for name, path in names.items():
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
        if path == p.fact:
            spark.catalog.recoverPartitions(f"{database}.{name}")
    return sorted(names)


def load_star(spark: SparkSession, p: SilverPaths, with_fact: bool = True, history: int | None = None) -> X.Star:
    """The silver star read back; the user table is the stored change log, turned into SCD2
    intervals at read time (keys stay those of the stored versions)."""
    versions = spark.read.parquet(p.users)
    largest = history if history is not None else D.history_size(versions)
    scd2 = D.dim_user_scd2(versions, plain=largest <= D.DEFAULT_MAX_GROUP_ROWS)
    users = scd2.join(versions.select("user_id", "updated_at", "user_sk"),
                      (scd2.user_id == versions.user_id) & (scd2.valid_from == versions.updated_at)).drop(
        versions.user_id).drop("updated_at")
    products = latest_products(spark.read.parquet(p.products))
    dates = spark.read.parquet(p.dates)
    fact = spark.read.parquet(p.fact) if with_fact else None
    return X.Star(fact, users, products, dates)


def run_gold(spark: SparkSession, p: SilverPaths, out_root: str | None = None,
             funnel_steps=config.FEED_FUNNEL_STEPS) -> dict[str, DataFrame]:
    """Gold KPIs from the written star; written (overwrite) when ``out_root`` is given."""
    star = load_star(spark, p)
    results = {
        "daily_kpis": K.daily_kpis(star.fact),
        "funnel_metrics": K.funnel_metrics(star.fact),
        "product_metrics": K.product_metrics(star),
        "top_purchasers": K.top_purchasers(star),
        "daily_kpis_volume": K.daily_kpis_volume(star.fact),
        "best_products": K.best_products(star.fact),
        "best_categories": K.best_categories(star),
        "best_month": K.best_month(star),
        "best_weekday": K.best_weekday(star),
        "avg_sales_period": K.avg_sales_period(star),
        "avg_sale_per_user": K.avg_sale_per_user(star.fact),
        "session_funnel": K.session_funnel(spark.read.parquet(p.events), funnel_steps),
    }
    if out_root:
        for name, df in results.items():
            feeds.write_table(df, f"{out_root}/{name}")
    return results
