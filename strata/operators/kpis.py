"""Gold KPIs over the silver star.

Money is summed exactly (decimal) and averages/ratios are rounded with integer arithmetic
(half-up), so results do not depend on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import config
from strata.operators.facts import Star

PURCHASE = "purchase"


def _int_div_sql(a: str, b: str) -> str:
    """Exact floor(a / b) for a >= 0, b > 0 on longs: a - a % b is a multiple of b."""
    return f"CAST((({a}) - ({a}) % ({b})) / ({b}) AS BIGINT)"


def ratio_sql(num: str, den: str, digits: int) -> str:
    """round(num / den, digits), half-up, computed on integers (exact)."""
    scale = 10 ** digits
    n, d = f"CAST({num} AS BIGINT) * {2 * scale}", f"CAST({den} AS BIGINT)"
    return f"CASE WHEN {d} > 0 THEN CAST({_int_div_sql(f'{n} + {d}', f'{d} * 2')} / {float(scale)} AS DOUBLE) END"


def money_avg_sql(total: str, n: str) -> str:
    """Average of an exact money total (six decimals) over n, rounded half-up to cents once, on whole numbers."""
    micros, per = f"CAST({total} * 1000000 AS DECIMAL(38,0))", f"CAST({n} AS DECIMAL(20,0))"
    return f"CASE WHEN {n} > 0 THEN CAST(({micros} * 2 + {per} * 10000) div ({per} * 20000) / 100.0 AS DOUBLE) END"


LIVE_SQL = (f"user_sk <> {config.UNKNOWN_SK} AND date_key <> {config.UNKNOWN_SK} "
            f"AND product_sk <> {config.UNKNOWN_SK}")


def _live(fact: DataFrame) -> DataFrame:
    """Fact rows whose three keys resolved. Because every key in the fact came from its
    dimension, this equals the inner star join without doing it."""
    return fact.where(LIVE_SQL)


# ---- as written, without the fan-out ------------------------------------------------------------
class Fanned:
    """The as-written star by its multiplicities.

    As written, the fact repeats a clean event once for each version of its user and each row of its
    product. Sums and counts over those copies are sums over the events weighted with both numbers, so
    the copies are never made: versions per user and rows per product are counted once and joined to the
    events many-to-one. An event without a user or product keeps weight 1 (the unknown member)."""

    def __init__(self, clean: DataFrame, users: DataFrame, products: DataFrame, dates: DataFrame):
        versions = users.groupBy("user_id").agg(F.count(F.lit(1)).alias("_versions")).withColumnRenamed("user_id", "_u")
        rows = products.groupBy("product_id").agg(F.count(F.lit(1)).alias("_rows")).withColumnRenamed("product_id", "_p")
        days = dates.select(F.col("full_date").alias("_d")).distinct()
        self.products = products
        self.events = (clean.join(versions, F.expr("user_id = _u"), "left").join(rows, F.expr("product_id = _p"), "left")
                       .join(days, F.expr("event_date = _d"), "left"))

    def live(self) -> DataFrame:
        """The events that survive the inner star join."""
        return self.events.where("_versions IS NOT NULL AND _rows IS NOT NULL AND _d IS NOT NULL")


_WEIGHT = "coalesce(_versions, 1) * coalesce(_rows, 1)"
_MONEY = "CAST(price AS DECIMAL(20,6))"


def _distinct_user_keys() -> Column:
    """Distinct user keys among rows of one user each: every version of a known user, and
    the unknown member once."""
    return F.expr("CAST(coalesce(sum(_versions), 0) + max(CASE WHEN _versions IS NULL THEN 1 ELSE 0 END) AS BIGINT)")


def daily_kpis_as_written(star: Fanned) -> DataFrame:
    per = star.events.groupBy("event_date", "session_id", "user_id").agg(
        F.first("_versions").alias("_versions"), F.expr(f"sum({_MONEY} * {_WEIGHT}) AS _rev"))
    users = per.groupBy("event_date", "user_id").agg(F.first("_versions").alias("_versions"), F.sum("_rev").alias("_rev"))
    by_user = users.groupBy("event_date").agg(_distinct_user_keys().alias("distinct_users"),
                                              F.expr("CAST(round(sum(_rev), 2) AS DOUBLE) AS total_revenue"))
    sessions = per.groupBy("event_date").agg(F.expr("count(DISTINCT session_id) AS sessions")).withColumnRenamed("event_date", "_day")
    return by_user.join(sessions, F.expr("event_date <=> _day")).select("event_date", "distinct_users", "sessions", "total_revenue")


def funnel_metrics_as_written(star: Fanned) -> DataFrame:
    users = star.events.groupBy("event_type", "user_id").agg(
        F.first("_versions").alias("_versions"), F.expr(f"sum(CASE WHEN event_type IS NOT NULL THEN {_WEIGHT} ELSE 0 END) AS _n"))
    return (users.groupBy("event_type").agg(F.expr("CAST(sum(_n) AS BIGINT) AS total_events"),
                                            _distinct_user_keys().alias("total_users"))
            .orderBy(F.desc("total_events"), "event_type"))


def product_metrics_as_written(star: Fanned) -> DataFrame:
    """Each product's events are summed once, then met by the product's rows (at most four times)."""
    per = star.live().groupBy("product_id").agg(F.expr("sum(_versions) AS _n"), F.expr(f"sum({_MONEY} * _versions) AS _rev"))
    out = star.products.select("product_id", "category").join(per, "product_id").groupBy("product_id", "category").agg(
        F.expr("CAST(sum(_n) AS BIGINT) AS total_interactions"), F.expr("CAST(round(sum(_rev), 2) AS DOUBLE) AS revenue"))
    return out.orderBy(F.desc("revenue"), F.desc("total_interactions"), "product_id")


def top_purchasers_as_written(star: Fanned) -> DataFrame:
    """Every purchaser, as the original orders them all."""
    per = star.live().where(f"event_type = '{PURCHASE}'").groupBy("user_id", "product_id", "event_id").agg(
        F.expr(f"sum({_MONEY} * _versions * _rows) AS _rev"))
    out = per.groupBy("user_id").agg(
        F.expr("count(DISTINCT product_id) AS product_count"), F.expr("CAST(round(sum(_rev), 2) AS DOUBLE) AS purchase_totals"),
        F.expr("count(DISTINCT event_id) AS transactions"))
    return out.orderBy(F.desc("purchase_totals"), "user_id")


# ---- F1 / F2 -----------------------------------------------------------------------------------
def _per_session(fact: DataFrame, user: str) -> DataFrame:
    """One row per (date, session, user) with its event count and exact revenue. Two exact
    distinct counts plan as an Expand that doubles its input; done over this reduced frame
    (partial-aggregated map-side) instead of the whole fact, the doubling is cheap."""
    return fact.groupBy("event_date", "session_id", user).agg(
        F.expr("count(1) AS _n"), F.expr("sum(CAST(price AS DECIMAL(24,6))) AS _rev"))


def daily_kpis(fact: DataFrame) -> DataFrame:
    """Per event_date: distinct users, distinct sessions, revenue = sum(price)."""
    return _per_session(fact, "user_id").groupBy("event_date").agg(
        F.expr("count(DISTINCT user_id) AS distinct_users"),
        F.expr("count(DISTINCT session_id) AS sessions"),
        F.expr("CAST(round(sum(_rev), 2) AS DOUBLE) AS total_revenue"),
    )


def daily_kpis_volume(fact: DataFrame) -> DataFrame:
    return _per_session(fact, "user_id").groupBy("event_date").agg(
        F.expr("CAST(sum(_n) AS BIGINT) AS total_events"),
        F.expr("count(DISTINCT user_id) AS active_users"),
        F.expr("count(DISTINCT session_id) AS sessions"),
        F.expr("CAST(round(sum(_rev), 2) AS DOUBLE) AS total_revenue"),
    )


# ---- F3 ------------------------------------------------------------------------------------------
def funnel_metrics(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("event_type")
            .agg(F.expr("count(event_type) AS total_events"), F.expr("count(DISTINCT user_id) AS total_users"))
            .orderBy(F.desc("total_events"), "event_type"))


# ---- F4 ------------------------------------------------------------------------------------------
def product_metrics(star: Star) -> DataFrame:
    """Per (product, category): interactions and revenue, best first. Eager aggregation: the fact is
    reduced to one row per product_sk before it meets the product dimension."""
    per_sk = _live(star.fact).groupBy("product_sk").agg(
        F.expr("count(1) AS _n"), F.expr("sum(CAST(price AS DECIMAL(24,6))) AS _rev"))
    joined = per_sk.join(star.products.select("product_sk", "product_id", "category"), "product_sk")
    out = joined.groupBy("product_id", "category").agg(
        F.expr("CAST(sum(_n) AS BIGINT) AS total_interactions"),
        F.expr("CAST(round(sum(_rev), 2) AS DOUBLE) AS revenue"))
    return out.orderBy(F.desc("revenue"), F.desc("total_interactions"), "product_id")


# ---- F5 ------------------------------------------------------------------------------------------
def top_purchasers(star: Star, limit: int | None = 50) -> DataFrame:
    """Purchases per user: distinct products, total, transactions; by total desc (user_id as tie-break).
    The fact has one row per event, so transactions are a count; products are counted over one row per
    (user, product), combined map-side. A limit plans as TakeOrderedAndProject."""
    per = _live(star.fact).where(f"event_type = '{PURCHASE}'").groupBy("user_id", "product_id").agg(
        F.expr("count(1) AS _n"), F.expr("sum(CAST(price AS DECIMAL(24,6))) AS _rev"))
    out = per.groupBy("user_id").agg(
        F.expr("count(product_id) AS product_count"), F.expr("CAST(round(sum(_rev), 2) AS DOUBLE) AS purchase_totals"),
        F.expr("CAST(sum(_n) AS BIGINT) AS transactions")).orderBy(F.desc("purchase_totals"), "user_id")
    return out.limit(limit) if limit else out


# ---- F6 ------------------------------------------------------------------------------------------
def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.expr("count(1) AS row_count")).selectExpr(f"'{name}' AS table_name", "row_count")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- F7 / F8: best sellers (purchases; sales = price x quantity) ---------------------------------
def _sales(fact: DataFrame) -> DataFrame:
    return (_live(fact).where(f"event_type = '{PURCHASE}'")
            .withColumn("_sale", F.expr("CAST(price AS DECIMAL(18,6)) * CAST(coalesce(quantity, 0) AS DECIMAL(10,0))")))


_UNITS = "CAST(sum(coalesce(quantity, 0)) AS BIGINT) AS units_sold"
_SALES = "CAST(round(sum(_sale), 2) AS DOUBLE) AS sales"


def best_products(fact: DataFrame) -> DataFrame:
    return (_sales(fact).groupBy("product_id").agg(F.expr(_UNITS), F.expr(_SALES))
            .orderBy(F.desc("sales"), "product_id"))


def _partial_sales(fact: DataFrame, key: str) -> DataFrame:
    return _sales(fact).groupBy(key).agg(F.expr("sum(coalesce(quantity, 0)) AS _u"), F.expr("sum(_sale) AS _c"))


def _rollup() -> list[Column]:
    return [F.expr("CAST(sum(_u) AS BIGINT) AS units_sold"), F.expr("CAST(round(sum(_c), 2) AS DOUBLE) AS sales")]


def best_categories(star: Star) -> DataFrame:
    joined = _partial_sales(star.fact, "product_sk").join(star.products.select("product_sk", "category"), "product_sk")
    return joined.groupBy("category").agg(*_rollup()).orderBy(F.desc("sales"), "category")


def daily_sales(star: Star) -> DataFrame:
    """Sales per date key first (one row per day), then the calendar attributes by key."""
    return _partial_sales(star.fact, "date_key").join(star.dates, "date_key")


def best_month(star: Star) -> DataFrame:
    return (daily_sales(star).groupBy("year", "month", "monthname").agg(*_rollup())
            .orderBy(F.desc("sales"), "year", "month"))


def best_weekday(star: Star) -> DataFrame:
    return daily_sales(star).groupBy("weekday", "dayname").agg(*_rollup()).orderBy(F.desc("sales"), "weekday")


# ---- F9 / F10: averages -----------------------------------------------------------------------
def avg_sales_period(star: Star) -> DataFrame:
    """Mean of period totals for week, month and quarter, from daily totals in one pass."""
    return period_averages(daily_sales(star).select("full_date", "_c"))


def period_averages(daily: DataFrame) -> DataFrame:
    """From exact totals ``_c`` by ``full_date``: weeks are ISO weeks of ISO years, so the days around
    a turn of the year fall into one week and weeks of different years stay apart."""
    periods = ("inline(array(named_struct('period', 'week', 'pkey', extract(YEAROFWEEK FROM full_date) * 100 + weekofyear(full_date)), "
               "named_struct('period', 'month', 'pkey', year(full_date) * 100 + month(full_date)), "
               "named_struct('period', 'quarter', 'pkey', year(full_date) * 100 + quarter(full_date))))")
    exploded = daily.selectExpr("_c", periods)
    totals = exploded.groupBy("period", "pkey").agg(F.expr("sum(_c) AS _t"))
    out = totals.groupBy("period").agg(F.expr("count(1) AS periods"), F.expr("sum(_t) AS _all"))
    return out.selectExpr("period", "periods", f"{money_avg_sql('_all', 'periods')} AS avg_sales")


def avg_sale_per_user(fact: DataFrame) -> DataFrame:
    per_user = _sales(fact).groupBy("user_id").agg(F.expr("sum(_sale) AS _t"))
    out = per_user.agg(F.expr("count(1) AS purchasing_users"), F.expr("sum(_t) AS _all"))
    return out.selectExpr("purchasing_users", "CAST(round(_all, 2) AS DOUBLE) AS total_sales",
                          f"{money_avg_sql('_all', 'purchasing_users')} AS avg_sale_per_user")


# ---- F11: session funnel ----------------------------------------------------------------------
def session_funnel(events: DataFrame, steps=config.FEED_FUNNEL_STEPS) -> DataFrame:
    """Share of sessions that reach each step, a step counting only when every earlier step
    happened in the session too. One aggregate per session (partial, skew-safe), then one
    global aggregate; the output has one row per step."""
    per_session = events.groupBy("session_id").agg(
        *[F.expr(f"bool_or(event_type = '{s}') AS _s{i}") for i, s in enumerate(steps)])
    counts = [F.expr(f"count_if({' AND '.join(f'_s{j}' for j in range(i + 1))}) AS _r{i}") for i in range(len(steps))]
    totals = per_session.agg(F.expr("count(1) AS _sessions"), *counts)
    rows = ", ".join(f"named_struct('step_index', {i + 1}, 'step', '{s}', 'sessions_reached', _r{i}, "
                     f"'_prev', {f'_r{i - 1}' if i else '_sessions'})" for i, s in enumerate(steps))
    out = totals.selectExpr("_sessions", f"inline(array({rows}))")
    return out.selectExpr(
        "step_index", "step", "sessions_reached",
        f"{ratio_sql('sessions_reached', '_sessions', 4)} AS conversion",
        f"{ratio_sql('sessions_reached', '_prev', 4)} AS step_conversion",
    )
