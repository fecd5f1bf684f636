"""Registered queries: name -> (Spark callable(spark, sf_dir), oracle SQL or None).

Each callable reads the driver's tables from ``sf_dir`` and runs the operator over all of them.
The oracle SQL is the independent DuckDB formulation used by the correctness gate.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config
from strata import oracle as O
from strata.operators import clean as C
from strata.operators import dims as D
from strata.operators import facts as X
from strata.operators import kpis as K
from strata.operators import quality as Q
from strata.operators.keys import assign_surrogate_keys
from strata.session import configure
from strata.sources import testdata as T

AS_OF = config.TEST_AS_OF
CART = config.TEST_CART_TYPES


class Inputs:
    """Lazily derived inputs for one query run (nothing is computed until an action)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        """Bronze events: the feed with the anomaly overlay."""
        return T.dirty_events(self.spark, self.sf_dir, CART)

    @cached_property
    def users(self) -> DataFrame:
        return T.user_feed(self.spark, self.sf_dir)

    @cached_property
    def changes(self) -> DataFrame:
        """The user feed without its first-signup columns, for operators that need only the versions."""
        return T.user_changes(self.spark, self.sf_dir)

    @cached_property
    def history(self) -> int:
        """Largest user history, bounded at the source (signup events per user)."""
        return T.user_history_bound(self.spark, self.sf_dir)

    @cached_property
    def norm(self) -> DataFrame:
        return Q.normalize_strings(self.raw, "intended")

    def clean(self, mode: str = "intended") -> DataFrame:
        return self._clean[mode]

    @cached_property
    def _clean(self) -> dict:
        return {m: C.clean_events(self.raw, m, AS_OF, CART) for m in config.MODES}

    def star(self, mode: str = "intended") -> X.Star:
        """The silver star; its inputs are written once, as the silver job does, so the three
        dimensions and the fact do not each recompute the cleaning."""
        if mode not in self._stars:
            from strata.session import materialize

            clean = materialize(self.clean(mode), f"silver-events-{mode}")
            raw = materialize(self.raw, "bronze-events") if mode == "as_written" else self.raw
            self._stars[mode] = star = X.build_star(clean, raw, self.changes if mode == "intended" else self.users, mode, AS_OF, self.history)
            star.events = clean
        return self._stars[mode]

    @cached_property
    def fanned(self) -> K.Fanned:
        """The as-written star as events with multiplicities."""
        return K.Fanned(self.clean("as_written"), D.dim_user_latest(self.users), D.dim_product_first4(self.raw, AS_OF),
                        D.dim_date(self.raw))

    @cached_property
    def _stars(self) -> dict:
        return {}


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))
        run.__name__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, run, O.sql(sql) if sql else None)
        return fn
    return deco


EVENT_COLS = "event_id, user_id, session_id, event_time, event_type, product_id, category, device, country, price, quantity"


# ================================ gold =========================================================
@register("daily_kpis", f"""SELECT event_date, count(DISTINCT user_id) AS distinct_users,
        count(DISTINCT session_id) AS sessions, {O.money('price')} AS total_revenue
    FROM fact_iw GROUP BY event_date""")
def _daily_kpis(x: Inputs):
    """F1 on the intended fact: distinct users, sessions, revenue per day. The fact's joins to its dimensions
    neither drop nor repeat an event and the KPI uses no key, so it reads the events behind the fact."""
    return K.daily_kpis(x.clean())


@register("daily_kpis_as_written", f"""SELECT event_date, count(DISTINCT user_sk) AS distinct_users,
        count(DISTINCT session_id) AS sessions, {O.money('price')} AS total_revenue
    FROM fact_aw GROUP BY event_date""")
def _daily_kpis_aw(x: Inputs):
    """F1 as written: every copy of an event counts, distinct user_sk (versions); by multiplicities."""
    return K.daily_kpis_as_written(x.fanned)


@register("daily_kpis_volume", f"""SELECT event_date, count(*) AS total_events, count(DISTINCT user_id) AS active_users,
        count(DISTINCT session_id) AS sessions, {O.money('price')} AS total_revenue
    FROM fact_iw GROUP BY event_date""")
def _daily_kpis_volume(x: Inputs):
    """F2, over the events behind the fact as F1."""
    return K.daily_kpis_volume(x.clean())


@register("funnel_metrics", """SELECT event_type, count(event_type) AS total_events, count(DISTINCT user_id) AS total_users
    FROM fact_iw GROUP BY event_type""")
def _funnel(x: Inputs):
    """events and distinct users per event type, over the events behind the fact as F1."""
    return K.funnel_metrics(x.clean())


@register("funnel_metrics_as_written", """SELECT event_type, count(event_type) AS total_events,
        count(DISTINCT user_sk) AS total_users FROM fact_aw GROUP BY event_type""")
def _funnel_aw(x: Inputs):
    return K.funnel_metrics_as_written(x.fanned)


@register("product_metrics", f"""SELECT p.product_id, p.category, count(*) AS total_interactions,
        {O.money('f.price')} AS revenue
    FROM live_iw f JOIN products_iw p ON f.product_sk = p.product_sk GROUP BY p.product_id, p.category""")
def _product_metrics(x: Inputs):
    """F4 with eager aggregation before the product join."""
    return K.product_metrics(x.star())


@register("product_metrics_as_written", f"""SELECT dim_product_id AS product_id, category, count(*) AS total_interactions,
        {O.money('price')} AS revenue FROM star_aw GROUP BY dim_product_id, category""")
def _product_metrics_aw(x: Inputs):
    return K.product_metrics_as_written(x.fanned)


@register("top_purchasers", f"""SELECT user_id, count(DISTINCT product_id) AS product_count,
        {O.money('price')} AS purchase_totals, count(DISTINCT event_id) AS transactions
    FROM live_iw WHERE event_type = 'purchase' GROUP BY user_id
    ORDER BY purchase_totals DESC, user_id LIMIT 50""")
def _top_purchasers(x: Inputs):
    """the top 50 purchasing users (total desc, user_id tie-break)."""
    return K.top_purchasers(x.star(), limit=50)


@register("top_purchasers_all", f"""SELECT dim_user_id AS user_id, count(DISTINCT dim_product_id) AS product_count,
        {O.money('price')} AS purchase_totals, count(DISTINCT event_id) AS transactions
    FROM star_aw WHERE event_type = 'purchase' GROUP BY dim_user_id""")
def _top_purchasers_all(x: Inputs):
    """F5 as written: every purchasing user, ordered, no limit, over the fan-out star."""
    return K.top_purchasers_as_written(x.fanned)


@register("active_users_by_period", """SELECT 'day' AS period, event_date AS starts, count(DISTINCT user_id) AS members FROM clean_iw GROUP BY 2
    UNION ALL SELECT 'week', CAST(date_trunc('week', event_date) AS DATE), count(DISTINCT user_id) FROM clean_iw GROUP BY 2
    UNION ALL SELECT 'month', CAST(date_trunc('month', event_date) AS DATE), count(DISTINCT user_id) FROM clean_iw GROUP BY 2""")
def _active_users(x: Inputs):
    """exact distinct users of days, weeks and months from one stored table of daily bitmaps."""
    from strata.operators import distincts
    from strata.session import materialize

    events = x.clean()
    numbers = assign_surrogate_keys(events.select("user_id").distinct(), ["user_id"], "user_no")
    bitmaps = materialize(distincts.day_bitmaps(events, numbers), "user-bitmaps")
    day, week, month = (distincts.distinct_members(bitmaps, p) for p in distincts.PERIODS)
    return day.unionByName(week).unionByName(month)


@register("product_metrics_ranked", f"""SELECT *, rank() OVER (ORDER BY revenue DESC, total_interactions DESC) AS rank FROM (
        SELECT p.product_id, p.category, count(*) AS total_interactions, {O.money('f.price')} AS revenue
        FROM live_iw f JOIN products_iw p ON f.product_sk = p.product_sk GROUP BY p.product_id, p.category) m""")
def _product_metrics_ranked(x: Inputs):
    """F4 + G5: the order as a rank column."""
    from strata.operators.ranking import with_rank

    return with_rank(K.product_metrics(x.star()), ["revenue", "total_interactions"])


@register("purchasers_ranked", """SELECT *, rank() OVER (ORDER BY transactions DESC) AS rank FROM (
        SELECT user_id, count(*) AS transactions FROM clean_iw WHERE event_type = 'purchase' GROUP BY user_id) u""")
def _purchasers_ranked(x: Inputs):
    """Purchasers by number of purchases, with many ties."""
    from strata.operators.ranking import with_rank

    per = x.clean().where("event_type = 'purchase'").groupBy("user_id").agg(F.expr("count(1) AS transactions"))
    return with_rank(per, ["transactions"])


# Days that are sent again with other prices.
_AGAIN = ("2024-01-05", "2024-01-20")


@register("product_metrics_bucketed", f"""SELECT p.product_id, p.category, count(*) AS total_interactions,
        {O.money('f.price')} AS revenue
    FROM live_iw f JOIN products_iw p ON f.product_sk = p.product_sk GROUP BY p.product_id, p.category""")
def _product_metrics_bucketed(x: Inputs):
    """F4 + E5 + A10: over catalog tables bucketed by the product key."""
    from strata import jobs
    from strata.sources import tables

    p = _silver(x)
    db = "bucketed_" + p.root.rsplit("-", 1)[-1]
    jobs.bucket_star(x.spark, p, db, 8)
    return K.product_metrics(X.Star(tables.scan(x.spark, f"{db}.fact_by_product"), None, tables.scan(x.spark, f"{db}.products"), None))


_NULLS = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in EVENT_COLS.split(", "))


@register("load_metrics", f"""SELECT 'batch' AS source, count(*) AS rows, {_NULLS} FROM raw_ev
    UNION ALL SELECT 'stream', count(*), {_NULLS} FROM raw_ev""")
def _load_metrics(x: Inputs):
    """C5 + F6 + E4: rows and nulls of a batch and a stream load, taken from the writes themselves."""
    from strata.operators import metrics
    from strata.session import scratch_path
    from strata.sources import feeds
    from strata.streaming import ingest

    landing, columns = _landing(x), [c.strip() for c in EVENT_COLS.split(",")]
    batch, seen = metrics.observed(feeds.stamp(feeds.read_json(x.spark, landing)), columns)
    feeds.write_table(batch, scratch_path(x.spark, "bronze_measured"))
    listener = metrics.StreamCounts("bronze")
    x.spark.streams.addListener(listener)
    try:
        stream = ingest.stamp_stream(ingest.read_stream(x.spark, landing, max_files_per_trigger=3)).observe("bronze", *metrics.counts(columns))
        query = ingest.write_stream(stream, scratch_path(x.spark, "bronze_stream_measured"), scratch_path(x.spark, "ckpt"))
        ingest.run_to_completion(query)
        streamed = listener.totals(query)
    finally:
        x.spark.streams.removeListener(listener)
    names = ["rows", *columns]
    return x.spark.createDataFrame([("batch", *[int(seen.get[n]) for n in names]), ("stream", *[int(streamed[n]) for n in names])],
                                   "source string, " + ", ".join(f"{n} long" for n in names))


@register("refresh_days", f"""SELECT event_date, count(*) AS events, {O.money(f"CASE WHEN event_date IN (DATE '{_AGAIN[0]}', DATE '{_AGAIN[1]}') THEN price + 1 ELSE price END")} AS revenue
    FROM clean_iw GROUP BY event_date""")
def _refresh_days(x: Inputs):
    """Two days loaded again replace their partitions of silver events; all others stay."""
    from strata import jobs
    from strata.session import scratch_path
    from strata.sources import feeds

    p = jobs.SilverPaths(scratch_path(x.spark, "refresh"))
    feeds.write_table(x.clean(), p.events, partition_by=["event_date"])
    days = ", ".join(f"DATE '{d}'" for d in _AGAIN)
    later = x.raw.where(f"to_date(event_time) IN ({days})").withColumn("price", F.col("price") + 1)
    jobs.refresh_days(x.spark, later, p, AS_OF, CART)
    return x.spark.read.parquet(p.events).groupBy("event_date").agg(
        F.expr("count(1) AS events"), F.expr("CAST(round(sum(CAST(price AS DECIMAL(24,6))), 2) AS DOUBLE) AS revenue"))


@register("events_between", """SELECT event_id, event_time, event_date FROM clean_iw
    WHERE event_time >= TIMESTAMP '2024-01-03 06:00:00' AND event_time < TIMESTAMP '2024-01-05 12:30:00'""")
def _events_between(x: Inputs):
    """A time range over stored events opens the days of the range only."""
    from strata.session import scratch_path
    from strata.sources import feeds

    path = scratch_path(x.spark, "events_by_day")
    feeds.write_table(x.clean(), path, partition_by=["event_date"])
    stored = x.spark.read.parquet(path)
    return feeds.between(stored, "2024-01-03 06:00:00", "2024-01-05 12:30:00").select("event_id", "event_time", "event_date")


@register("row_counts", """SELECT 'bronze_events' AS table_name, count(*) AS row_count FROM raw_ev
    UNION ALL SELECT 'silver_events', count(*) FROM clean_iw
    UNION ALL SELECT 'silver_user', count(*) FROM users_iw
    UNION ALL SELECT 'silver_product', count(*) FROM products_iw
    UNION ALL SELECT 'silver_date', count(*) FROM dates_iw
    UNION ALL SELECT 'silver_fact', count(*) FROM fact_iw""")
def _row_counts(x: Inputs):
    """row count of every layer in one job."""
    s = x.star()
    return K.row_counts({"bronze_events": x.raw, "silver_events": s.events, "silver_user": s.users,
                         "silver_product": s.products, "silver_date": s.dates, "silver_fact": s.fact})


_UNITS = f"CAST(sum(coalesce(quantity, 0)) AS BIGINT) AS units_sold, {O.total('_sale')} AS sales"


@register("best_products", f"SELECT product_id, {_UNITS} FROM sales_iw GROUP BY product_id")
def _best_products(x: Inputs):
    """purchase units and sales (price x quantity) per product, best first."""
    return K.best_products(x.star().fact)


@register("best_categories", f"""SELECT p.category, CAST(sum(coalesce(s.quantity, 0)) AS BIGINT) AS units_sold,
        {O.total('s._sale')} AS sales
    FROM sales_iw s JOIN products_iw p ON s.product_sk = p.product_sk GROUP BY p.category""")
def _best_categories(x: Inputs):
    return K.best_categories(x.star())


@register("best_month", f"""SELECT d.year, d.month, d.monthname, CAST(sum(coalesce(s.quantity, 0)) AS BIGINT) AS units_sold,
        {O.total('s._sale')} AS sales
    FROM sales_iw s JOIN dates_iw d ON s.date_key = d.date_key GROUP BY d.year, d.month, d.monthname""")
def _best_month(x: Inputs):
    """F8: sales per calendar month."""
    return K.best_month(x.star())


@register("best_weekday", f"""SELECT d.weekday, d.dayname, CAST(sum(coalesce(s.quantity, 0)) AS BIGINT) AS units_sold,
        {O.total('s._sale')} AS sales
    FROM sales_iw s JOIN dates_iw d ON s.date_key = d.date_key GROUP BY d.weekday, d.dayname""")
def _best_weekday(x: Inputs):
    return K.best_weekday(x.star())


@register("avg_sales_period", f"""SELECT period, count(*) AS periods, {O.money_avg('sum(c)', 'count(*)')} AS avg_sales
    FROM (
        SELECT 'week' AS period, isoyear(d.full_date) * 100 + weekofyear(d.full_date) AS pkey, sum(s._sale) AS c
            FROM sales_iw s JOIN dates_iw d ON s.date_key = d.date_key GROUP BY 1, 2
        UNION ALL SELECT 'month', d.year * 100 + d.month, sum(s._sale)
            FROM sales_iw s JOIN dates_iw d ON s.date_key = d.date_key GROUP BY 1, 2
        UNION ALL SELECT 'quarter', d.year * 100 + d.quarter, sum(s._sale)
            FROM sales_iw s JOIN dates_iw d ON s.date_key = d.date_key GROUP BY 1, 2) t
    GROUP BY period""")
def _avg_sales_period(x: Inputs):
    """mean sales per week / month / quarter."""
    return K.avg_sales_period(x.star())


# The test tables cover one January; moved so that they run from one year's end into the next.
_YEAR_END_SHIFT = 16


@register("avg_sales_year_end", f"""SELECT period, count(*) AS periods, {O.money_avg('sum(c)', 'count(*)')} AS avg_sales
    FROM (
        SELECT 'week' AS period, strftime(day, '%G-%V') AS pkey, sum(c) AS c FROM moved GROUP BY 1, 2
        UNION ALL SELECT 'month', strftime(day, '%Y-%m'), sum(c) FROM moved GROUP BY 1, 2
        UNION ALL SELECT 'quarter', CAST(year(day) AS VARCHAR) || '-' || CAST(quarter(day) AS VARCHAR), sum(c) FROM moved GROUP BY 1, 2) t
    GROUP BY period""".replace("moved", f"(SELECT event_date - {_YEAR_END_SHIFT} AS day, _sale AS c FROM sales_iw) m"))
def _avg_sales_year_end(x: Inputs):
    """F9 over dates that cross a turn of the year: ISO weeks, not calendar year and week number."""
    daily = K.daily_sales(x.star()).selectExpr(f"date_sub(full_date, {_YEAR_END_SHIFT}) AS full_date", "_c")
    return K.period_averages(daily)


@register("avg_sale_per_user", f"""SELECT count(*) AS purchasing_users, {O.total('t')} AS total_sales,
        {O.money_avg('sum(t)', 'count(*)')} AS avg_sale_per_user
    FROM (SELECT user_id, sum(_sale) AS t FROM sales_iw GROUP BY user_id) u""")
def _avg_sale_per_user(x: Inputs):
    """total purchase sales over purchasing users."""
    return K.avg_sale_per_user(x.star().fact)


_STEPS = config.TEST_FUNNEL_STEPS


def _funnel_sql() -> str:
    flags = ", ".join(f"bool_or(event_type = '{s}') AS s{i}" for i, s in enumerate(_STEPS))
    reached = []
    cond = "TRUE"
    for i, _ in enumerate(_STEPS):
        cond = f"{cond} AND s{i}"
        reached.append(f"count(*) FILTER (WHERE {cond}) AS r{i}")
    rows = []
    for i, s in enumerate(_STEPS):
        prev = f"r{i - 1}" if i else "n"
        rows.append(f"""SELECT {i + 1} AS step_index, '{s}' AS step, r{i} AS sessions_reached,
            {O.int_ratio(f'r{i}', 'n', 4)} AS conversion, {O.int_ratio(f'r{i}', prev, 4)} AS step_conversion FROM tot""")
    return (f"""ps AS (SELECT session_id, {flags} FROM clean_iw GROUP BY session_id),
        tot AS (SELECT count(*) AS n, {', '.join(reached)} FROM ps)
        """ + " UNION ALL ".join(rows))


@register("session_funnel", None)
def _session_funnel(x: Inputs):
    """share of sessions reaching each funnel step (view -> click -> purchase)."""
    return K.session_funnel(x.clean(), _STEPS)


REGISTRY["session_funnel"].sql = O.PREFIX.rstrip("\n") + ",\n" + _funnel_sql()


# ================================ quality (bronze -> silver) ====================================
@register("normalize_strings", f"""SELECT {EVENT_COLS} FROM norm_iw""")
def _normalize(x: Inputs):
    """Trim + lower of the dirty string columns, one projection."""
    return x.norm


@register("normalize_strings_as_written", f"""SELECT {EVENT_COLS} FROM norm_aw""")
def _normalize_aw(x: Inputs):
    return Q.normalize_strings(x.raw, "as_written")


@register("dedup_events", f"""SELECT DISTINCT ON (event_id) {EVENT_COLS} FROM raw_ev ORDER BY event_id""")
def _dedup(x: Inputs):
    """One row per event_id (partial aggregate, skew-safe)."""
    return Q.dedupe(x.raw, ["event_id"])


@register("distinct_quantities", "SELECT DISTINCT event_type, quantity FROM norm_iw")
def _distinct_quantities(x: Inputs):
    """C4/C14: distinct (event_type, quantity) pairs."""
    return Q.distinct_values(x.norm, ["event_type", "quantity"])


@register("null_profile", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in EVENT_COLS.split(", ")) + " FROM raw_ev")
def _null_profile(x: Inputs):
    """Null count per column, one global aggregate."""
    return Q.null_profile(x.raw)


@register("fill_unknown", f"""SELECT * REPLACE (coalesce(category, 'unknown') AS category,
        coalesce(country, 'unknown') AS country, coalesce(device, 'unknown') AS device) FROM raw_ev""")
def _fill(x: Inputs):
    """C6: 'unknown' for null category / country / device."""
    return Q.fill_unknown(x.raw)


@register("drop_required_nulls", """SELECT * FROM raw_ev
    WHERE user_id IS NOT NULL AND event_time IS NOT NULL AND session_id IS NOT NULL""")
def _drop_required(x: Inputs):
    """Drop rows missing user_id, event_time or session_id."""
    return Q.drop_required_nulls(x.raw)


@register("quantity_as_written", f"""SELECT * FROM norm_iw
    WHERE NOT ((event_type IN ({O.CART}) AND quantity <= 0) OR quantity IS NULL)""")
def _q_aw(x: Inputs):
    """The original predicate -- drops every null quantity (all non-cart events)."""
    return Q.filter_quantity(x.norm, "as_written", CART)


@register("quantity_notebook", f"""SELECT * FROM norm_iw
    WHERE NOT (event_type IN ({O.CART}) AND quantity <= 0 AND quantity IS NULL)""")
def _q_nb(x: Inputs):
    """The notebook's variant -- drops only null quantity on cart types."""
    return Q.filter_quantity(x.norm, "notebook", CART)


@register("quantity_intended", f"""SELECT * FROM norm_iw
    WHERE (quantity IS NULL OR quantity >= 0)
      AND NOT (coalesce(event_type IN ({O.CART}), false) AND (quantity IS NULL OR quantity <= 0))""")
def _q_iw(x: Inputs):
    """Negatives dropped everywhere; null / 0 dropped on cart types only."""
    return Q.filter_quantity(x.norm, "intended", CART)


@register("product_required", f"""SELECT * FROM norm_iw
    WHERE NOT (event_type IN ({O.CART}) AND product_id IS NULL)""")
def _product_required(x: Inputs):
    """C10 as written: cart events need a product."""
    return Q.filter_product(x.norm, "as_written", CART)


@register("product_required_intended", "SELECT * FROM norm_iw WHERE product_id IS NOT NULL")
def _product_required_iw(x: Inputs):
    """C10 intended: no event without a product."""
    return Q.filter_product(x.norm, "intended", CART)


@register("positive_price", "SELECT * FROM raw_ev WHERE NOT (TRY_CAST(price AS DOUBLE) <= 0)")
def _positive_price(x: Inputs):
    """C11 as written: drops price <= 0, null, unparseable."""
    return Q.filter_positive_price(x.raw)


def _odd(x: Inputs) -> Inputs:
    """The inputs with prices that are no amounts of money."""
    odd = Inputs(x.spark, x.sf_dir)
    odd.raw = T.odd_prices(x.raw)
    return odd


_PRICE = "TRY_CAST(price AS DOUBLE)"


@register("price_rules", None)
def _price_rules(x: Inputs):
    """C11/C17: which rule each event's price breaks, NaN, infinite and huge prices among them, and what each mode keeps."""
    rows = _odd(x).raw.select("event_id", "price")
    return rows.selectExpr("event_id", f"coalesce({Q.price_sql('intended')}, false) AS kept", f"coalesce({Q.price_sql('as_written')}, false) AS kept_as_written",
                           "coalesce(price >= 1e9, false) AS out_of_range")


@register("daily_kpis_odd_prices", None)
def _daily_kpis_odd(x: Inputs):
    """F2 over a feed with impossible prices: they are rejected, and no sum overflows."""
    return K.daily_kpis_volume(_odd(x).clean())


@register("best_products_odd_prices", None)
def _best_products_odd(x: Inputs):
    """F7 with prices of three decimals: totals are rounded once."""
    return K.best_products(_odd(x).star().fact)


REGISTRY["price_rules"].sql = O.with_odd_prices(
    f"""SELECT event_id, coalesce({_PRICE} > 0 AND {_PRICE} < {config.MAX_PRICE}, false) AS kept,
        coalesce(NOT ({_PRICE} <= 0), false) AS kept_as_written, coalesce(price >= 1e9, false) AS out_of_range FROM raw_ev""")
REGISTRY["daily_kpis_odd_prices"].sql = O.with_odd_prices(
    f"""SELECT event_date, count(*) AS total_events, count(DISTINCT user_id) AS active_users,
        count(DISTINCT session_id) AS sessions, {O.money('price')} AS total_revenue FROM clean_iw GROUP BY event_date""")
REGISTRY["best_products_odd_prices"].sql = O.with_odd_prices(f"SELECT product_id, {_UNITS} FROM sales_iw GROUP BY product_id")


@register("drop_future", f"SELECT * FROM raw_ev WHERE event_time <= TIMESTAMP '{AS_OF}'")
def _drop_future(x: Inputs):
    """Events after the as-of time are dropped."""
    return Q.drop_future(x.raw, AS_OF)


@register("time_range", f"""SELECT min(event_time) AS min_event_time, max(event_time) AS max_event_time,
        max(event_time) FILTER (WHERE event_time <= TIMESTAMP '{AS_OF}') AS max_event_time_kept FROM raw_ev""")
def _time_range(x: Inputs):
    """Min / max event time, and max among kept rows, in one aggregate."""
    return Q.time_range(x.raw, AS_OF)


@register("offenders", f"""SELECT event_id, event_type, product_id, quantity, 'before_1970' AS reason FROM norm_iw
        WHERE event_time < TIMESTAMP '1970-01-01 00:00:00'
    UNION ALL SELECT event_id, event_type, product_id, quantity, 'cart_missing_value' FROM norm_iw
        WHERE event_type IN ({O.CART}) AND (product_id IS NULL OR quantity IS NULL)
    UNION ALL SELECT event_id, event_type, product_id, quantity, 'null_attribute' FROM norm_iw
        WHERE category IS NULL OR country IS NULL OR device IS NULL""")
def _offenders(x: Inputs):
    """C14: (event, reason) for every broken expectation, one scan."""
    return Q.offenders(x.norm, CART)


@register("clean_events", "SELECT * FROM clean_iw")
def _clean(x: Inputs):
    """C15 intended pipeline (+B5-B7 conformance)."""
    return x.clean()


@register("clean_events_as_written", "SELECT * FROM clean_aw")
def _clean_aw(x: Inputs):
    """C15 as written: original operator order and predicates."""
    return x.clean("as_written")


@register("conform_events", """SELECT coalesce(event_id, 'unknown') AS event_id, coalesce(user_id, 'unknown') AS user_id,
        coalesce(session_id, 'unknown') AS session_id, event_time, CAST(event_time AS DATE) AS event_date,
        event_type, product_id, category, device, country, price, quantity FROM norm_iw""")
def _conform(x: Inputs):
    """Typed, ordered, nullability-enforced events (no rows dropped)."""
    return C.conform_events(x.norm)


@register("parse_quantity", """SELECT event_id,
        CASE WHEN regexp_full_match(CAST(quantity AS VARCHAR), '[0-9]{1,2}') THEN CAST(quantity AS DECIMAL(2,0)) END AS quantity
    FROM raw_ev""")
def _parse_quantity(x: Inputs):
    """to_number(quantity, '99') without failing on '-1' or '123'."""
    return Q.parse_quantity(x.raw.select("event_id", "quantity"))


@register("anomaly_report", f"""SELECT count(*) AS total_rows,
        count(*) FILTER (WHERE user_id IS NULL OR product_id IS NULL) AS null_user_or_product,
        count(*) FILTER (WHERE category IS NULL OR country IS NULL OR device IS NULL) AS null_device_country_category,
        count(*) - count(DISTINCT event_id) AS duplicate_events,
        count(*) FILTER (WHERE lower(trim(event_type)) IN ({O.CART}) AND (quantity IS NULL OR quantity <= 0)) AS invalid_quantity,
        count(*) FILTER (WHERE event_time > TIMESTAMP '{AS_OF}') AS future_event_time,
        count(*) FILTER (WHERE coalesce(event_type <> lower(trim(event_type)), false)
                            OR coalesce(device <> lower(trim(device)), false)) AS dirty_strings
    FROM raw_ev""")
def _anomaly_report(x: Inputs):
    """Counts of the six anomaly classes, one pass."""
    return Q.anomaly_report(x.raw, AS_OF, CART)


@register("quarantine", f"""SELECT event_id, NULLIF(concat_ws(',',
        CASE WHEN user_id IS NULL THEN 'null_user' END,
        CASE WHEN session_id IS NULL THEN 'null_session' END,
        CASE WHEN event_time IS NULL THEN 'null_event_time' END,
        CASE WHEN product_id IS NULL THEN 'null_product' END,
        CASE WHEN NOT coalesce((quantity IS NULL OR quantity >= 0)
             AND NOT (coalesce(event_type IN ({O.CART}), false) AND (quantity IS NULL OR quantity <= 0)), false)
             THEN 'invalid_quantity' END,
        CASE WHEN NOT coalesce(TRY_CAST(price AS DOUBLE) > 0, false) THEN 'non_positive_price' END,
        CASE WHEN coalesce(TRY_CAST(price AS DOUBLE) >= {config.MAX_PRICE}, false) THEN 'price_out_of_range' END,
        CASE WHEN coalesce(event_time > TIMESTAMP '{AS_OF}', false) THEN 'future_event' END), '') AS reject_reason
    FROM (SELECT DISTINCT ON (event_id) * FROM norm_iw ORDER BY event_id) d""")
def _quarantine(x: Inputs):
    """C17: every deduped row with its reject reasons (NULL = kept)."""
    return Q.quarantine(Q.dedupe(x.norm, ["event_id"]), AS_OF, CART).select("event_id", "reject_reason")


@register("backfill_category", """SELECT d.event_id, coalesce(d.category, p.category) AS category,
        coalesce(d.country, s.country) AS country
    FROM dedup_norm d
    LEFT JOIN bf_products p ON d.product_id = p.product_id
    LEFT JOIN scd2 s ON d.user_id = s.user_id AND d.event_time IS NOT NULL AND (d.event_time >= s.valid_from OR s.is_first)
        AND (s.valid_to IS NULL OR d.event_time < s.valid_to)""")
def _backfill(x: Inputs):
    """Null category from the product dimension, null country from the as-of user version."""
    events = Q.dedupe(x.norm, ["event_id"])
    out = D.backfill(events, D.dim_product(events), D.dim_user_scd2(x.changes, plain=x.history <= D.DEFAULT_MAX_GROUP_ROWS),
                     range_join=x.history <= D.MAX_VERSIONS_FOR_RANGE_JOIN)
    return out.select("event_id", "category", "country")


# ================================ dimensions ====================================================
@register("dim_user_latest", "SELECT * FROM dim_user_latest")
def _dim_user_latest(x: Inputs):
    """Latest-flag user dimension (rank 1 as max-join; ties all current)."""
    return D.dim_user_latest(x.users)


@register("dim_user_scd2", """SELECT user_id, country, loyalty_tier, valid_from, valid_to,
        valid_to IS NULL AS is_current, is_first FROM scd2""")
def _dim_user_scd2(x: Inputs):
    """Type-2 intervals on country + loyalty tier, unchanged versions merged."""
    return D.dim_user_scd2(x.changes, plain=x.history <= D.DEFAULT_MAX_GROUP_ROWS)


@register("asof_user", """SELECT c.event_id, c.user_id, c.event_time, s.valid_from AS version_from,
        s.country AS version_country, s.loyalty_tier AS version_loyalty_tier
    FROM clean_iw c LEFT JOIN scd2 s ON c.user_id = s.user_id
        AND (c.event_time >= s.valid_from OR s.is_first) AND (s.valid_to IS NULL OR c.event_time < s.valid_to)""")
def _asof_user(x: Inputs):
    """D3: the profile version valid at each event's time."""
    scd2 = D.dim_user_scd2(x.changes, plain=x.history <= D.DEFAULT_MAX_GROUP_ROWS)
    out = D.asof_join(x.clean(), scd2, range_join=x.history <= D.MAX_VERSIONS_FOR_RANGE_JOIN)
    return out.select("event_id", "user_id", "event_time", "version_from", "version_country", "version_loyalty_tier")


@register("asof_uncleaned", """SELECT d.event_id, s.valid_from AS by_range, s.valid_from AS by_carry
    FROM (SELECT event_id, user_id, CASE WHEN device IS NULL THEN NULL ELSE event_time END AS event_time FROM dedup_norm) d
    LEFT JOIN scd2 s ON d.user_id = s.user_id AND d.event_time IS NOT NULL
        AND (d.event_time >= s.valid_from OR s.is_first) AND (s.valid_to IS NULL OR d.event_time < s.valid_to)""")
def _asof_uncleaned(x: Inputs):
    """D3 on uncleaned events, null users and null times included, by both strategies."""
    events = Q.dedupe(x.norm, ["event_id"]).select(
        "event_id", "user_id", F.expr("CASE WHEN device IS NULL THEN NULL ELSE event_time END AS event_time"))
    scd2 = D.dim_user_scd2(x.changes, plain=x.history <= D.DEFAULT_MAX_GROUP_ROWS)
    by_range, by_carry = (D.asof_join(events, scd2, payload=(), range_join=r) for r in (True, False))
    return by_range.selectExpr("event_id", "version_from AS by_range").join(
        by_carry.selectExpr("event_id", "version_from AS by_carry"), "event_id", "full")


@register("scd2_by_ranges", """SELECT user_id, country, loyalty_tier, valid_from, valid_to,
        valid_to IS NULL AS is_current, is_first FROM scd2""")
def _scd2_by_ranges(x: Inputs):
    """D2 by ranges of (user, time) with about equally many rows, whatever a user holds."""
    return D.dim_user_scd2(x.changes, plain=False)


@register("scd2_two_batches", """SELECT user_id, country, loyalty_tier, valid_from, valid_to,
        valid_to IS NULL AS is_current, is_first FROM scd2""")
def _scd2_two_batches(x: Inputs):
    """D2 spliced: the change log in two batches with late changes gives the intervals of one batch."""
    from strata import jobs
    from strata.session import scratch_path

    root, changes = scratch_path(x.spark, "history"), D.user_versions(x.changes)
    for rest in (1, 0):
        jobs.splice_history(x.spark, changes.where(f"pmod(unix_seconds(updated_at) div 60, 2) = {rest}"), root)
    return x.spark.read.parquet(f"{root}/user_history").drop("part")


@register("users_with_history", """SELECT CAST(sum(n) AS BIGINT) AS user_records, count(*) AS users,
        count(*) FILTER (WHERE n > 1) AS users_with_history
    FROM (SELECT user_id, count(*) AS n FROM uv GROUP BY user_id) v""")
def _users_with_history(x: Inputs):
    """Records, users, and users with more than one version."""
    return D.users_with_history(x.users)


@register("dim_date", "SELECT * EXCLUDE (date_key) FROM dates_aw")
def _dim_date(x: Inputs):
    """Distinct event dates (raw bronze, as the original) with calendar attributes."""
    return D.dim_date(x.raw)


@register("dim_product_first4", "SELECT * FROM dim_product_first4")
def _dim_product_first4(x: Inputs):
    """First four (product, time) rows per product by dense rank (WindowGroupLimit)."""
    return D.dim_product_first4(x.raw, AS_OF)


@register("dim_product", "SELECT * EXCLUDE (product_sk) FROM products_iw")
def _dim_product(x: Inputs):
    """One row per product, latest non-null category."""
    return D.dim_product(x.clean())


@register("surrogate_keys", "SELECT user_sk, user_id, valid_from FROM users_iw")
def _surrogate_keys(x: Inputs):
    """Dense keys in natural-key order without a single-task window."""
    keyed = assign_surrogate_keys(D.dim_user_scd2(x.changes, plain=x.history <= D.DEFAULT_MAX_GROUP_ROWS),
                                  ["user_id", "valid_from"], "user_sk")
    return keyed.select("user_sk", "user_id", "valid_from")


# ================================ facts ==========================================================
FACT_COLS = ("event_id, event_time, event_date, event_type, user_id, product_id, user_sk, date_key, product_sk, "
             "session_id, device, price, quantity")


@register("fact_events", f"SELECT {FACT_COLS} FROM fact_iw")
def _fact(x: Inputs):
    """E1-E4 intended: one row per clean event, as-of user key, -1 for unknown members."""
    return x.star().fact


@register("fact_events_as_written", f"SELECT {FACT_COLS} FROM fact_aw")
def _fact_aw(x: Inputs):
    """E1-E4 as written: natural-key joins, rows repeated per user version x product row."""
    return x.star("as_written").fact


@register("fact_unknown_members", """SELECT count(*) FILTER (WHERE user_sk = -1) AS unknown_user_sk,
        count(*) FILTER (WHERE date_key = -1) AS unknown_date_key,
        count(*) FILTER (WHERE product_sk = -1) AS unknown_product_sk, count(*) AS fact_rows FROM fact_iw""")
def _fact_unknown(x: Inputs):
    """Rows falling back to the unknown member, per key."""
    return X.unknown_member_counts(x.star().fact)


@register("star_join", """SELECT event_id, dim_user_id, country, dim_product_id, category, full_date, year, month,
        weekday, price FROM star_aw""")
def _star_join(x: Inputs):
    """E5: inner star join over the three surrogate keys (as written)."""
    s = X.star_join(x.star("as_written"))
    return s.select("event_id", "dim_user_id", "country", "dim_product_id", "category", "full_date", "year",
                    "month", "weekday", "price")


# ================================ loads and catalog ==============================================
def _load_twice(batch: DataFrame, path: str, keys, key_name=None, key_order=None, partition_by=None) -> DataFrame:
    from strata.operators.load import append_new

    first = append_new(batch, path, list(keys), key_name=key_name, key_order=key_order, partition_by=partition_by)
    second = append_new(batch, path, list(keys), key_name=key_name, key_order=key_order, partition_by=partition_by)
    if second:
        raise AssertionError(f"second load of the same batch appended {second} rows (first: {first})")
    return batch.sparkSession.read.parquet(path)


@register("load_user", """SELECT row_number() OVER (ORDER BY user_id, updated_at) AS user_sk, user_id, updated_at,
        country, loyalty_tier FROM uv""")
def _load_user(x: Inputs):
    """E6 + A11: user change log loaded twice (anti-join on (user_id, updated_at)); keys continue max+1."""
    from strata.session import scratch_path

    path = scratch_path(x.spark, "silver_user")
    out = _load_twice(D.user_versions(x.changes), path, ["user_id", "updated_at"], "user_sk", ["user_id", "updated_at"])
    return out.select("user_sk", "user_id", "updated_at", "country", "loyalty_tier")


@register("load_product", "SELECT product_sk, product_id, category, updated_ts FROM products_iw")
def _load_product(x: Inputs):
    from strata.session import scratch_path

    path = scratch_path(x.spark, "silver_product")
    out = _load_twice(D.dim_product(x.clean()), path, ["product_id"], "product_sk", ["product_id"])
    return out.select("product_sk", "product_id", "category", "updated_ts")


@register("load_date", "SELECT * FROM dates_iw")
def _load_date(x: Inputs):
    from strata.session import scratch_path

    path = scratch_path(x.spark, "silver_date")
    out = _load_twice(D.dim_date(x.clean()), path, ["full_date"], "date_key", ["full_date"])
    return out.select("full_date", "year", "quarter", "month", "monthname", "weekyear", "weekday", "dayname",
                      "day", "is_weekend", "date_key")


@register("load_events", f"SELECT {FACT_COLS} FROM fact_iw")
def _load_events(x: Inputs):
    """E6 for the fact: partitioned by event_date; the anti-join reads only touched partitions."""
    from strata.session import scratch_path

    path = scratch_path(x.spark, "silver_events")
    out = _load_twice(x.star().fact, path, ["event_id"], partition_by=["event_date"])
    return out.select(*[c.strip() for c in FACT_COLS.split(",")])


# Two batches of the user change log, by the day of the change; the first is sent again.
_LATER = "2024-01-16 00:00:00"


@register("load_ledger", f"""SELECT b AS batch_id, CAST(count(*) AS BIGINT) AS rows, max(max(sk)) OVER (ORDER BY b) AS greatest_key FROM (
        SELECT CASE WHEN updated_at < TIMESTAMP '{_LATER}' THEN 'first' ELSE 'second' END AS b,
            row_number() OVER (ORDER BY updated_at >= TIMESTAMP '{_LATER}', user_id, updated_at) AS sk FROM uv) k GROUP BY b""")
def _load_ledger(x: Inputs):
    """Batches noted in the table's ledger; keys go on from it, a batch sent again is skipped."""
    from strata.operators.ledger import batches
    from strata.operators.load import append_new
    from strata.session import scratch_path

    path, log = scratch_path(x.spark, "user_ledger"), D.user_versions(x.changes)
    first, second = (log.where(f"updated_at {op} TIMESTAMP '{_LATER}'") for op in ("<", ">="))
    for name, batch in (("first", first), ("second", second), ("first", first)):
        append_new(batch, path, ["user_id", "updated_at"], key_name="user_sk", batch_id=name)
    return batches(x.spark, path).select("batch_id", "rows", "greatest_key")


def _describe_sql() -> str:
    from strata import schemas

    cols = ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in schemas.DIM_USER_SCD2.fields)
    return (f"""SELECT d.col_name, d.data_type, CAST(NULL AS VARCHAR) AS comment,
        (SELECT count(*) FROM scd2) AS rows_loaded
    FROM (VALUES {cols}) AS d(col_name, data_type)""")


@register("describe_silver", _describe_sql())
def _describe_silver(x: Inputs):
    """Database + external tables at stable locations, loaded, then described."""
    from strata import schemas
    from strata.session import scratch_path
    from strata.sources import tables

    root = scratch_path(x.spark, "silver_db")
    db = "silver_" + root.rsplit("-", 1)[-1]
    tables.ensure_database(x.spark, db, root)
    tables.ensure_table(x.spark, f"{db}.silver_user", schemas.DIM_USER_SCD2, f"{root}/silver_user")
    scd2 = D.dim_user_scd2(x.changes, plain=x.history <= D.DEFAULT_MAX_GROUP_ROWS)
    tables.append_to_table(scd2.drop("is_first"), f"{db}.silver_user")
    loaded = tables.scan(x.spark, f"{db}.silver_user").count()
    return tables.describe(x.spark, f"{db}.silver_user").withColumn("rows_loaded", F.lit(loaded).cast("long"))


@register("silver_quarantine", f"""SELECT event_id, user_id IS NULL AS no_user, product_id IS NULL AS no_product,
        coalesce(event_time > TIMESTAMP '{AS_OF}', false) AS in_future FROM dedup_norm
    WHERE event_id NOT IN (SELECT event_id FROM clean_iw)""")
def _silver_quarantine(x: Inputs):
    """C17: the rejected events that the silver job stores, read back."""
    p = _silver(x)
    return x.spark.read.parquet(p.rejected).selectExpr(
        "event_id", "user_id IS NULL AS no_user", "product_id IS NULL AS no_product",
        f"coalesce(event_time > TIMESTAMP '{AS_OF}', false) AS in_future")


@register("silver_fact_stamped", """SELECT row_number() OVER (ORDER BY event_id) AS event_sk, event_id, product_sk,
        TIMESTAMP '2024-06-01 00:00:00' AS ingestion_ts, 'part' AS ip_file_name FROM fact_iw""")
def _silver_fact_stamped(x: Inputs):
    """A11 + B1: the stored fact with its surrogate key and ingestion stamps (file name reduced to its stem)."""
    p = _silver(x, x.raw.selectExpr("*", "TIMESTAMP '2024-06-01 00:00:00' AS ingestion_ts", "'part-0001.json' AS ip_file_name"))
    return x.spark.read.parquet(p.fact).selectExpr(
        "event_sk", "event_id", "product_sk", "ingestion_ts", "split_part(ip_file_name, '-', 1) AS ip_file_name")


@register("silver_product_versions", """SELECT product_id, category, version FROM (
        SELECT product_id, category, 1 AS version FROM products_iw
        UNION ALL SELECT product_id, upper(category), 2 FROM products_iw WHERE category IS NOT NULL AND upper(category) <> category) v""")
def _silver_product_versions(x: Inputs):
    """D7 + E6: a second load with changed categories appends a version of each changed product."""
    from strata import jobs
    from strata.session import scratch_path

    path = scratch_path(x.spark, "product_versions")
    products = D.dim_product(x.clean())
    later = products.withColumns({"category": F.upper("category"), "updated_ts": F.expr("updated_ts + INTERVAL 1 DAY")})
    for batch in (products, products, later, later):
        jobs.load_products(batch, path)
    return x.spark.read.parquet(path).selectExpr(
        "product_id", "category", "CAST(row_number() OVER (PARTITION BY product_id ORDER BY updated_ts) AS INT) AS version")


def _silver(x: Inputs, events: DataFrame | None = None):
    from strata import jobs
    from strata.session import scratch_path

    return jobs.run_silver(x.spark, x.raw if events is None else events, x.changes, scratch_path(x.spark, "silver"), AS_OF, CART)


# ================================ ingest (batch and stream) ======================================
_FEED_SQL = ("SELECT event_id, user_id, session_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS event_time, "
             "event_type, product_id, category, device, country, price, quantity FROM raw_ev")


def _landing(x: Inputs) -> str:
    from strata.session import scratch_path
    from strata.sources import feeds

    path = scratch_path(x.spark, "landing")
    feeds.write_json(x.raw, path)
    return path


@register("batch_ingest", _FEED_SQL)
def _batch_ingest(x: Inputs):
    """JSON landing -> explicit-schema read -> stamps -> bronze overwrite -> read back."""
    from strata.session import scratch_path
    from strata.sources import feeds

    bronze = feeds.ingest_batch(x.spark, _landing(x), scratch_path(x.spark, "bronze"))
    if bronze.filter(F.col("ingestion_ts").isNull() | F.col("ip_file_name").isNull()).limit(1).count():
        raise AssertionError("bronze rows without ingestion stamps")
    return bronze.select(*feeds.feed_columns())


@register("stream_ingest", _FEED_SQL)
def _stream_ingest(x: Inputs):
    """File stream over the landing folder -> parquet sink, availableNow."""
    from strata.session import scratch_path
    from strata.sources import feeds
    from strata.streaming import ingest

    bronze = ingest.ingest_stream(x.spark, _landing(x), scratch_path(x.spark, "bronze_stream"),
                                  scratch_path(x.spark, "ckpt"))
    return bronze.select(*feeds.feed_columns())


# Some lines of the feed replaced by broken ones, by event id: (divisor, line before and after the id, reason, id readable).
_BROKEN = [(53, '{"event_id": "', '", "user_id": "us', "malformed", False), (59, '{"event_id": "', '", "price": "n/a", "device": "x"}', "bad_field", True),
           (61, "{}", None, "empty", False), (47, "not json ", "", "malformed", False)]


def _broken(kind: str, otherwise: str) -> str:
    """CASE over the broken forms: their line, raw text, reason or readable id (both dialects)."""
    whens = []
    for by, before, after, reason, known in _BROKEN:
        line = f"'{before}'" if after is None else f"concat('{before}', event_id, '{after}')"
        what = {"line": line, "raw": "NULL" if after is None else line, "reason": f"'{reason}'", "id": "event_id" if known else "NULL"}[kind]
        whens.append(f"WHEN CAST(event_id AS BIGINT) % {by} = 0 THEN {what}")
    return f"CASE {' '.join(whens)} ELSE {otherwise} END"


_CHECKED_SQL = (f"SELECT {_broken('id', 'event_id')} AS event_id, {_broken('raw', 'NULL')} AS raw_line, {_broken('reason', 'NULL')} AS reject_reason, "
                "TRUE AS stamped FROM raw_ev")


def _broken_landing(x: Inputs) -> str:
    from strata.session import scratch_path
    from strata.sources import feeds

    path = scratch_path(x.spark, "landing_broken")
    feeds.to_feed_json(x.raw).selectExpr(f"{_broken('line', 'to_json(struct(*))')} AS value").write.text(path)
    return path


def _kept_and_rejected(x: Inputs, bronze: str) -> DataFrame:
    from strata.sources import feeds

    stamped = "ingestion_ts IS NOT NULL AND contains(ip_file_name, '/part-') AS stamped"
    good = feeds.events(x.spark, bronze).selectExpr("event_id", "CAST(NULL AS STRING) AS raw_line", "CAST(NULL AS STRING) AS reject_reason", stamped)
    return good.unionByName(feeds.rejected_lines(x.spark, bronze).selectExpr("event_id", "raw_line", "reject_reason", stamped))


@register("batch_ingest_rejects", _CHECKED_SQL)
def _batch_ingest_rejects(x: Inputs):
    """A2/B1: a landing with broken lines; each is kept with its text, file and reason, none becomes an event."""
    from strata.session import scratch_path
    from strata.sources import feeds

    bronze = scratch_path(x.spark, "bronze_checked")
    feeds.ingest_checked(x.spark, _broken_landing(x), bronze)
    return _kept_and_rejected(x, bronze)


@register("stream_ingest_rejects", _CHECKED_SQL)
def _stream_ingest_rejects(x: Inputs):
    """A1/H7: the same landing as a stream; events and rejected lines are committed together."""
    from strata.session import scratch_path
    from strata.streaming import ingest

    bronze = scratch_path(x.spark, "bronze_stream_checked")
    ingest.ingest_stream_checked(x.spark, _broken_landing(x), bronze, scratch_path(x.spark, "ckpt"))
    return _kept_and_rejected(x, bronze)


@register("stream_replay", "SELECT DISTINCT ON (event_id) * FROM (" + _FEED_SQL + ") ORDER BY event_id")
def _stream_replay(x: Inputs):
    """H6: the same landing replayed from a fresh checkpoint into an idempotent sink adds nothing."""
    from strata.session import scratch_path
    from strata.sources import feeds
    from strata.streaming import ingest

    landing, target = _landing(x), scratch_path(x.spark, "bronze_idem")

    def with_date(df):  # partition column: each micro-batch reads only the dates it touches
        return df.withColumn("event_date", F.to_date(F.try_to_timestamp("event_time")))

    def replay():
        ingest.replay_stream(x.spark, landing, target, scratch_path(x.spark, "ckpt"), ["event_id"],
                             partition_by=["event_date"], derive=with_date)

    replay()
    before = x.spark.read.parquet(target).count()
    replay()
    after = x.spark.read.parquet(target)
    if after.count() != before:
        raise AssertionError("replay from a fresh checkpoint changed the target")
    return after.select(*feeds.feed_columns())
