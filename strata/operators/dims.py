"""Silver dimensions: user (latest-flag and true SCD2), as-of lookup, date, product.

Per-key work is written as aggregates (partial + final, combined map-side) plus joins, which
AQE can split when a key is hot, instead of windows over a whole key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import config, schemas
from strata.functions.columns import as_date, as_timestamp, calendar, date_lit, ts_lit
from strata.operators import quality
from strata.operators.sequence import DEFAULT_MAX_GROUP_ROWS, dealt_by_range, plain_window_is_safe, with_neighbours

TRACKED_USER_ATTRIBUTES = ("country", "loyalty_tier")


# ---- D1: user dimension with a latest flag (as written) -------------------------------------
def dim_user_latest(user_feed: DataFrame) -> DataFrame:
    """One row per feed version: effective_from = signup date, effective_to = change time,
    is_current = the version with the greatest change time (ties are all current, like rank 1).

    rank() == 1 over (user order by updated_at desc) is computed as updated_at == max per user:
    a partial aggregate joined back on user_id, so a user with a huge history is split by AQE
    instead of being sorted in one task.
    """
    feed = quality.normalize_strings(user_feed, "as_written")
    feed = feed.withColumns({"_from": as_date(feed, "signup_date"), "_to": as_timestamp(feed, "updated_at")})
    latest = feed.groupBy("user_id").agg(F.max("_to").alias("_max_to")).withColumnRenamed("user_id", "_latest_of")
    # Null-safe: versions without a user are one group, as they are for rank().
    flagged = feed.join(latest, F.expr("user_id <=> _latest_of"), "left").select(
        F.coalesce("user_id", F.lit(config.UNKNOWN)).alias("user_id"),
        "country",
        F.coalesce("_from", date_lit(config.DEFAULT_DATE)).alias("effective_from"),
        F.col("_to").alias("effective_to"),
        F.coalesce(F.col("_to") == F.col("_max_to"), F.lit(False)).alias("is_current"),
    )
    return quality.dedupe(flagged, ["user_id", "effective_from", "effective_to"]).to(schemas.DIM_USER_LATEST)


# ---- D2: true SCD2 history ----------------------------------------------------------------------
def user_versions(user_feed: DataFrame) -> DataFrame:
    """The append-only change log: one row per (user_id, updated_at), typed."""
    feed = user_feed.select("user_id", as_timestamp(user_feed, "updated_at").alias("updated_at"),
                            *TRACKED_USER_ATTRIBUTES).where("user_id IS NOT NULL AND updated_at IS NOT NULL")
    return quality.dedupe(feed, ["user_id", "updated_at"])


def history_size(user_feed: DataFrame) -> int:
    """Largest number of feed rows of one user (one partial aggregate, one number returned):
    an upper bound on versions per user, so it decides the window and as-of strategies."""
    from strata.operators.sequence import largest_group

    return largest_group(user_feed, "user_id")


def dim_user_scd2(user_feed: DataFrame, plain: bool | None = None) -> DataFrame:
    """Type-2 intervals [valid_from, valid_to) per user on the tracked attributes.

    A version that changes neither tracked attribute is merged into the one before it; the
    last version is open (valid_to NULL) and current. ``is_first`` marks the first version,
    whose lower bound the as-of lookup opens.
    """
    if plain is None:  # one measurement serves both passes: the kept rows are a subset
        plain = plain_window_is_safe(user_feed, "user_id")
    # Plain path: one hash partitioning on user_id serves the dedupe aggregate and both windows.
    versions = user_versions(user_feed.repartition("user_id") if plain else user_feed)
    with_prev = with_neighbours(versions, "user_id", "updated_at", list(TRACKED_USER_ATTRIBUTES),
                                next=False, plain=plain)
    changed = " OR ".join(["_prev IS NULL"] + [f"NOT (`{a}` <=> _prev.`{a}`)" for a in TRACKED_USER_ATTRIBUTES])
    kept = with_prev.where(changed).selectExpr("*", "_prev IS NULL AS is_first").drop("_prev")
    with_next = with_neighbours(kept, "user_id", "updated_at", [], prev=False, plain=plain)
    return with_next.selectExpr(
        "user_id", *TRACKED_USER_ATTRIBUTES,
        "updated_at AS valid_from",
        "_next.updated_at AS valid_to",
        "_next IS NULL AS is_current",
        "is_first",
    )


# ---- D3: profile as of event time --------------------------------------------------------------
MAX_VERSIONS_FOR_RANGE_JOIN = 10_000


def asof_join(events: DataFrame, scd2: DataFrame, payload=("country", "loyalty_tier"), range_join: bool | None = None) -> DataFrame:
    """Each event gets the user version valid at its event_time (the first version when the
    event precedes all of them); unknown users and events without a time keep NULL attributes.
    Both strategies give the same rows (compared by the ``asof_uncleaned`` query and the tests).

    Range join (default when every user has at most ``MAX_VERSIONS_FOR_RANGE_JOIN`` versions,
    measured): an equi-join on user_id with a range residual; AQE splits a hot user on the
    event side and each event checks at most that many versions. Beyond the bound, a carry-
    forward over events and versions merged in time order, cut by ranges of (user, time) with about equally
    many rows (no task holds a whole user), which relies on the intervals being contiguous, as ``dim_user_scd2`` makes them.
    """
    if range_join is None:
        range_join = plain_window_is_safe(scd2, "user_id", MAX_VERSIONS_FOR_RANGE_JOIN)
    if not range_join:
        return _asof_by_carry(events, scd2, payload)
    dim = scd2.selectExpr("user_id AS _uid", "valid_from AS _vf", "valid_to AS _vt", "is_first AS _first",
                          *[f"`{c}` AS `_v_{c}`" for c in payload],
                          *(["user_sk AS _v_user_sk"] if "user_sk" in scd2.columns else []))
    cond = F.expr("user_id = _uid AND event_time IS NOT NULL AND (event_time >= _vf OR _first) AND (_vt IS NULL OR event_time < _vt)")
    joined = events.join(dim, cond, "left")
    renamed = {f"_v_{c}": f"version_{c}" for c in payload}
    if "user_sk" in scd2.columns:
        renamed["_v_user_sk"] = "user_sk"
    out = joined.withColumnsRenamed(renamed).withColumnRenamed("_vf", "version_from")
    return out.drop("_uid", "_vt", "_first")


def _asof_by_carry(events: DataFrame, scd2: DataFrame, payload) -> DataFrame:
    from pyspark.sql import Window

    fields = ["valid_from", *payload, *(["user_sk"] if "user_sk" in scd2.columns else [])]
    vstruct = "struct(" + ", ".join(f"`{c}`" for c in fields) + ")"
    versions = scd2.selectExpr("user_id", "valid_from AS _t", "0 AS _kind", f"{vstruct} AS _v")
    ev = events.selectExpr("*", "event_time AS _t", "1 AS _kind", f"CAST(NULL AS {_struct_type(scd2, fields)}) AS _v")
    merged = dealt_by_range(ev.unionByName(versions, allowMissingColumns=True), ["user_id", "_t", "_kind"], "asof-merged")
    w_in = Window.partitionBy("user_id", "_b").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    merged = merged.withColumn("_in", F.last("_v", ignorenulls=True).over(w_in))
    # One summary row per (user, range): bounded by the number of ranges.
    summary = merged.groupBy("user_id", "_b").agg(
        F.expr("max(CASE WHEN _kind = 0 THEN struct(_t, _v) END) AS _last"),
        F.expr("min(CASE WHEN _kind = 0 THEN struct(_t, _v) END) AS _first"))
    w_b = Window.partitionBy("user_id").orderBy("_b")
    edges = summary.select(
        "user_id", "_b",
        F.last("_last", ignorenulls=True).over(w_b.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
        F.first("_first", ignorenulls=True).over(w_b.rowsBetween(Window.unboundedPreceding,
                                                                 Window.unboundedFollowing)).alias("_first_v"))
    ev_rows = merged.where("_kind = 1").join(edges, ["user_id", "_b"], "left")
    out = ev_rows.withColumn("_ver", F.expr("CASE WHEN _t IS NOT NULL THEN coalesce(_in, _carry._v, _first_v._v) END"))
    cols = {"version_from": F.col("_ver.valid_from"), **{f"version_{c}": F.col(f"_ver.{c}") for c in payload}}
    if "user_sk" in scd2.columns:
        cols["user_sk"] = F.col("_ver.user_sk")
    return out.withColumns(cols).drop("_t", "_kind", "_v", "_b", "_in", "_carry", "_first_v", "_ver")


def _struct_type(df: DataFrame, fields) -> str:
    return "struct<" + ",".join(f"`{c}`:{df.schema[c].dataType.simpleString()}" for c in fields) + ">"


# ---- D4: users with history ---------------------------------------------------------------------
def users_with_history(user_feed: DataFrame) -> DataFrame:
    per_user = user_versions(user_feed).groupBy("user_id").agg(F.count(F.lit(1)).alias("_versions"))
    return per_user.agg(F.sum("_versions").cast("long").alias("user_records"),
                        F.count(F.lit(1)).alias("users"),
                        F.count_if(F.col("_versions") > 1).alias("users_with_history"))


# ---- D5: date dimension ---------------------------------------------------------------------------
def dim_date(events: DataFrame) -> DataFrame:
    """Distinct event dates with calendar attributes; a missing date becomes 1970-01-01.
    The distinct runs first (partial aggregate), so attributes are computed once per date."""
    dates = events.select(F.coalesce(as_date(events, "event_time"), date_lit(config.DEFAULT_DATE))
                          .alias("full_date")).distinct()
    return dates.withColumns(calendar("full_date")).to(schemas.DIM_DATE)


# ---- D6: product dimension, first four versions (as written) -------------------------------------
def dim_product_first4(events: DataFrame, as_of: str = config.TEST_AS_OF) -> DataFrame:
    """The first four event times of each product, one row per (product, time) with the least
    category. The rank plans as a partial WindowGroupLimit before the shuffle: only rows of a product's
    first four times leave a task. Dense rank ignores repeated times, so no distinct is needed."""
    seen = events.select(
        F.expr(f"coalesce(product_id, '{config.UNKNOWN}') AS product_id"), "category",
        F.coalesce(as_timestamp(events, "event_time"), ts_lit(as_of)).alias("updated_ts"))
    ranked = seen.withColumn("_rank", F.expr("dense_rank() OVER (PARTITION BY product_id ORDER BY updated_ts)"))
    return ranked.where("_rank <= 4").groupBy("product_id", "updated_ts").agg(
        F.min("category").alias("category")).select("product_id", "category", "updated_ts").to(schemas.DIM_PRODUCT)


# ---- D7: product dimension, one row per product ------------------------------------------------
def dim_product(events: DataFrame) -> DataFrame:
    """Latest non-null category per product (ties broken by the larger category), last seen time."""
    ts = as_timestamp(events, "event_time")
    agg = (events.where("product_id IS NOT NULL").withColumn("_ts", ts).groupBy("product_id")
           .agg(F.expr("max(CASE WHEN category IS NOT NULL THEN struct(_ts AS t, category AS c) END) AS _l"),
                F.expr("max(_ts) AS _t")))
    return agg.select(F.expr(f"coalesce(product_id, '{config.UNKNOWN}') AS product_id"),
                      F.expr("_l.c AS category"),
                      F.coalesce("_t", ts_lit(config.DEFAULT_TIMESTAMP)).alias("updated_ts")).to(schemas.DIM_PRODUCT)


# ---- C18: backfill from dimensions ----------------------------------------------------------
def backfill(events: DataFrame, products: DataFrame, scd2: DataFrame, range_join: bool | None = None) -> DataFrame:
    """Null category from the product dimension, null country from the user version valid at
    the event's time; what stays null is left for ``fill_unknown``."""
    prod = products.select(F.col("product_id").alias("_bp"), F.col("category").alias("_bcat"))
    with_prod = events.join(prod, F.col("product_id") == F.col("_bp"), "left")
    with_user = asof_join(with_prod, scd2, payload=("country",), range_join=range_join)
    return (with_user.withColumns({"category": F.coalesce("category", "_bcat"),
                                   "country": F.coalesce("country", "version_country")})
            .drop("_bp", "_bcat", "version_country", "version_from"))
