"""Adapter: the driver's generic tables -> the clickstream and user-change feed shapes.

The driver ships ``events`` (event_id, ts, user_id, event_type, value, props) plus TPC-H-style
``customer``, ``nation`` and ``part``. This module derives, with plain joins and projections
that Spark plans and prunes like any query:

* ``events_view``     - the clean clickstream feed,
* ``dirty_events``    - the same feed with a deterministic anomaly overlay (the six anomaly
                        classes of the feed, chosen by modulus on the numeric event id),
* ``user_feed``       - the user profile change feed (one version per ``signup`` event).

Every row of the output comes from a row of the input, so work grows with the tables.
Projections are written as SQL expression strings (``selectExpr``): one driver->JVM call per
projection instead of one per column operator, which dominates planning time on small data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config

# ---- fixed values: moduli of the dirty overlay, in priority order (first match wins) ------
NULL_USER_MOD = 67
NULL_PRODUCT_MOD = 71
NULL_ATTRIBUTE_MOD = 37       # device, country or category by event id % 3
DIRTY_TYPE_MOD = 31
BAD_QUANTITY_MOD = 7          # only on cart-type rows; value picked by event id % 4
BAD_QUANTITIES = (None, 0, -1, -3)
FUTURE_MOD = 89               # event_time moved 40..365 days ahead
FUTURE_MIN_DAYS = 40
FUTURE_SPAN_DAYS = 326
DUPLICATE_MOD = 33            # exact copy of a row no other class touched
# --------------------------------------------------------------------------------------------

_CLASSES = ("null_user", "null_product", "null_attribute", "dirty_type", "bad_quantity", "future", "duplicate")


#: Columns that the adapter reads; stated, so that no job opens a file to infer them.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_type string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, listed anew each time."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def odd_prices(df: DataFrame) -> DataFrame:
    """The feed with prices that are no amounts of money, and some of more than two decimals, by event id."""
    return df.withColumn("price", F.expr(
        "CASE CAST(event_id AS BIGINT) % 13 WHEN 0 THEN double('NaN') WHEN 1 THEN double('Infinity') WHEN 2 THEN double('-Infinity') "
        "WHEN 3 THEN 1e20 WHEN 4 THEN 1e9 WHEN 5 THEN 2.345 WHEN 6 THEN 0.005 ELSE price END"))


def spread(df: DataFrame, by: str | None = None) -> DataFrame:
    """Spread a scan that yields fewer partitions than the session has cores (a single
    row-group file is one task). A no-op at cluster scale, where scans have many splits. The size and number of
    the listed files tell, so a scan is not planned for it.

    ``by`` hash-partitions on an expression instead of round-robin: when a later projection
    names that same expression (e.g. ``CAST(event_id AS STRING) AS event_id``), Spark carries
    the partitioning through the alias and an aggregate on it needs no further shuffle."""
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) >= target * split:
        return df
    files = df.inputFiles()
    if (len(files) if files else df.rdd.getNumPartitions()) >= target:
        return df
    return df.repartition(target, F.expr(by)) if by else df.repartition(target)


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _with_country(spark: SparkSession, sf_dir: str, df: DataFrame, user_col: str) -> DataFrame:
    """Country of the user, by way of customer and nation; the planner's size check decides on broadcasts."""
    customer = read_table(spark, sf_dir, "customer").selectExpr("c_custkey AS _uid", "c_nationkey AS _nk")
    nation = read_table(spark, sf_dir, "nation").selectExpr("n_nationkey AS _nk", "n_name AS country")
    joined = df.join(customer, F.expr(f"{user_col} = _uid"), "left")
    return joined.join(nation, "_nk", "left").drop("_uid", "_nk")


def events_view(spark: SparkSession, sf_dir: str, cart_types=config.TEST_CART_TYPES,
                keep_numeric_id: bool = False) -> DataFrame:
    """The clean clickstream feed derived from ``events`` (+ customer/nation/part).

    ``json_tuple`` parses ``props`` once per row, and as a generator it keeps predicates on the
    product key above the spread instead of inside the single scan task."""
    ev = spread(read_table(spark, sf_dir, "events"), by="CAST(event_id AS STRING)").selectExpr(
        "event_id", "ts", "user_id", "event_type", "value", "json_tuple(props, 'k') AS _k")
    if keep_numeric_id:
        # The overlay keys on _n. Produced by a generator after the spread, predicates on it
        # (and on everything derived from it) stay above the spread and run in parallel.
        ev = ev.selectExpr("*", "stack(1, event_id) AS _n")
    part = read_table(spark, sf_dir, "part").selectExpr("p_partkey AS _pk", "p_type AS category")
    # Joins are left so no event is lost; small sides are broadcast by the planner's size check,
    # AQE re-plans from measured sizes and splits skewed keys otherwise.
    joined = _with_country(spark, sf_dir, ev, "user_id").join(part, F.expr("CAST(_k AS BIGINT) = _pk"), "left")
    devices = _sql_list(config.DEVICES)
    return joined.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "concat('user_', CAST(user_id AS STRING)) AS user_id",
        "concat('session_', CAST(user_id AS STRING), '_', CAST(to_date(ts) AS STRING)) AS session_id",
        "CAST(ts AS TIMESTAMP) AS event_time",
        "event_type",
        "concat('prod_', _k) AS product_id",
        "category",
        f"element_at(array({devices}), CAST(event_id % 3 + 1 AS INT)) AS device",
        "country",
        "value AS price",
        f"CASE WHEN event_type IN ({_sql_list(cart_types)}) THEN CAST(event_id % 5 + 1 AS INT) END AS quantity",
        *(["_n"] if keep_numeric_id else []),
    )


def _hits(cart_types) -> list[str]:
    return [f"_n % {NULL_USER_MOD} = 0", f"_n % {NULL_PRODUCT_MOD} = 0", f"_n % {NULL_ATTRIBUTE_MOD} = 0",
            f"_n % {DIRTY_TYPE_MOD} = 0",
            f"(_n % {BAD_QUANTITY_MOD} = 0 AND coalesce(event_type IN ({_sql_list(cart_types)}), false))",
            f"_n % {FUTURE_MOD} = 0", f"_n % {DUPLICATE_MOD} = 0"]


def class_sql(name: str, cart_types=config.TEST_CART_TYPES) -> str:
    """A row is in a class when its modulus hits and no earlier class's does. Flat conditions,
    cheap to inline when the optimizer pushes a filter through this projection."""
    hits = _hits(cart_types)
    i = _CLASSES.index(name)
    return "(" + " AND ".join([hits[i]] + [f"NOT {h}" for h in hits[:i]]) + ")"


def anomaly_class(cart_types=config.TEST_CART_TYPES):
    whens = " ".join(f"WHEN {class_sql(c, cart_types)} THEN '{c}'" for c in _CLASSES)
    return F.expr(f"CASE {whens} END")


def dirty_events(spark: SparkSession, sf_dir: str, cart_types=config.TEST_CART_TYPES) -> DataFrame:
    """The feed with the anomaly overlay; duplicates are generated in the same scan."""
    base = events_view(spark, sf_dir, cart_types, keep_numeric_id=True)

    def c(name):
        return class_sql(name, cart_types)

    bad_q = ", ".join("CAST(NULL AS INT)" if q is None else str(q) for q in BAD_QUANTITIES)
    return base.selectExpr(
        "event_id",
        f"CASE WHEN {c('null_user')} THEN NULL ELSE user_id END AS user_id",
        "session_id",
        f"CASE WHEN {c('future')} THEN timestampadd(DAY, CAST(_n % {FUTURE_SPAN_DAYS} + {FUTURE_MIN_DAYS} AS INT), "
        f"event_time) ELSE event_time END AS event_time",
        f"CASE WHEN {c('dirty_type')} THEN concat(' ', upper(event_type), ' ') ELSE event_type END AS event_type",
        f"CASE WHEN {c('null_product')} THEN NULL ELSE product_id END AS product_id",
        f"CASE WHEN {c('null_attribute')} AND _n % 3 = 2 THEN NULL ELSE category END AS category",
        f"CASE WHEN {c('null_attribute')} AND _n % 3 = 0 THEN NULL ELSE device END AS device",
        f"CASE WHEN {c('null_attribute')} AND _n % 3 = 1 THEN NULL ELSE country END AS country",
        "price",
        f"CASE WHEN {c('bad_quantity')} THEN element_at(array({bad_q}), CAST(_n % 4 + 1 AS INT)) "
        f"ELSE quantity END AS quantity",
        # one extra copy of each duplicate-class row, generated in place (no second scan)
        f"explode(sequence(1, CASE WHEN {c('duplicate')} THEN 2 ELSE 1 END)) AS _copy",
    ).drop("_copy")


def user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile version per ``signup`` event: tier from props.k, country from the customer."""
    # No spread here: the signup filter runs in the scan task and leaves a small share of rows.
    ev = read_table(spark, sf_dir, "events").where("event_type = 'signup'").selectExpr(
        "user_id", "ts", "json_tuple(props, 'k') AS _k")
    first = ev.groupBy("user_id").agg(F.expr("min(ts) AS _first_ts"))  # partial aggregate: skew-safe
    tiers = _sql_list(config.LOYALTY_TIERS)
    joined = _with_country(spark, sf_dir, ev.join(first, "user_id"), "user_id")
    return joined.selectExpr(
        "concat('user_', CAST(user_id AS STRING)) AS user_id",
        "concat('user_', CAST(user_id AS STRING), '@example.com') AS email",
        "country",
        f"element_at(array({tiers}), CAST(CAST(_k AS BIGINT) % 4 + 1 AS INT)) AS loyalty_tier",
        "to_date(_first_ts) AS signup_date",
        "CAST(ts AS TIMESTAMP) AS updated_at",
        "CASE WHEN ts = _first_ts THEN 'insert' ELSE 'update' END AS change_type",
    )


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions of :func:`user_feed` with the columns that a history needs: one scan of ``events``."""
    ev = read_table(spark, sf_dir, "events").where("event_type = 'signup'").selectExpr(
        "user_id", "ts", "json_tuple(props, 'k') AS _k")
    tiers = _sql_list(config.LOYALTY_TIERS)
    return _with_country(spark, sf_dir, ev, "user_id").selectExpr(
        "concat('user_', CAST(user_id AS STRING)) AS user_id", "country",
        f"element_at(array({tiers}), CAST(CAST(_k AS BIGINT) % 4 + 1 AS INT)) AS loyalty_tier", "CAST(ts AS TIMESTAMP) AS updated_at")


def user_history_bound(spark: SparkSession, sf_dir: str) -> int:
    """Largest number of feed versions of one user, measured at the source: one version per
    ``signup`` event, so a filtered scan (pushed to Parquet) and a partial aggregate suffice."""
    ev = read_table(spark, sf_dir, "events").where("event_type = 'signup'")
    return ev.groupBy("user_id").agg(F.expr("count(1) AS _n")).agg(F.expr("max(_n)")).first()[0] or 0
