"""Silver fact: events joined to their dimension surrogate keys; star denormalisation.

No join hint is forced: the dimensions grow with the data (user versions, products), and a hint
overrides Spark's size check. Read back from written tables they carry real file sizes, so the
planner broadcasts them when under ``autoBroadcastJoinThreshold`` and sort-merge joins them
otherwise; AQE re-plans at runtime from measured shuffle sizes and splits skewed keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import config, schemas
from strata.operators import dims
from strata.operators.keys import assign_surrogate_keys
from strata.operators.sequence import DEFAULT_MAX_GROUP_ROWS


@dataclass
class Star:
    """The silver star: fact plus keyed dimensions."""

    fact: DataFrame
    users: DataFrame
    products: DataFrame
    dates: DataFrame
    events: DataFrame | None = None  # the cleaned events behind the fact, where they are at hand


def keyed_dimensions(clean: DataFrame, raw: DataFrame, user_feed: DataFrame, mode: str = "intended",
                     as_of: str = config.TEST_AS_OF, plain_window: bool | None = None
                     ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dimensions with surrogate keys (dense, in natural-key order).

    intended:   SCD2 users, one-row products and dates from the cleaned events.
    as_written: latest-flag users, first-four products and dates from the raw (bronze) events.
    """
    config.check_mode(mode)
    if mode == "intended":
        scd2 = dims.dim_user_scd2(user_feed, plain=plain_window)
        users = assign_surrogate_keys(scd2, ["user_id", "valid_from"], "user_sk")
        products = assign_surrogate_keys(dims.dim_product(clean), ["product_id"], "product_sk")
        dates = assign_surrogate_keys(dims.dim_date(clean), ["full_date"], "date_key")
    else:
        users = assign_surrogate_keys(dims.dim_user_latest(user_feed),
                                      ["user_id", "effective_from", "effective_to"], "user_sk")
        products = assign_surrogate_keys(dims.dim_product_first4(raw, as_of), ["product_id", "updated_ts"],
                                         "product_sk")
        dates = assign_surrogate_keys(dims.dim_date(raw), ["full_date"], "date_key")
    return users, products, dates


def build_fact(clean: DataFrame, users: DataFrame, products: DataFrame, dates: DataFrame,
               mode: str = "intended", range_join: bool | None = None) -> DataFrame:
    """E1-E4. intended: one fact row per clean event -- the user key is the version valid at
    event time (as-of join), products have one row each. as_written: natural-key joins, so an
    event is repeated (user versions x product rows) times, as the original does."""
    config.check_mode(mode)
    date_keys = dates.selectExpr("full_date AS _d", "date_key")
    prod_keys = products.selectExpr("product_id AS _p", "product_sk")
    if mode == "intended":
        with_user = dims.asof_join(clean, users, payload=(), range_join=range_join).drop("version_from")
        joined = (with_user.join(prod_keys, F.expr("product_id = _p"), "left")
                  .join(date_keys, F.expr("event_date = _d"), "left"))
    else:
        user_keys = users.selectExpr("user_id AS _u", "user_sk")
        joined = (clean.join(user_keys, F.expr("user_id = _u"), "left")
                  .join(date_keys, F.expr("event_date = _d"), "left")
                  .join(prod_keys, F.expr("product_id = _p"), "left"))
    # Unknown member for every unmatched key.
    out = joined.withColumns({k: F.expr(f"coalesce({k}, CAST({config.UNKNOWN_SK} AS BIGINT))")
                              for k in ("user_sk", "date_key", "product_sk")})
    extra = [c for c in ("ingestion_ts", "ip_file_name") if c in clean.columns]
    return out.select(*[f.name for f in schemas.FACT_EVENTS.fields], *extra)


def build_star(clean: DataFrame, raw: DataFrame, user_feed: DataFrame, mode: str = "intended",
               as_of: str = config.TEST_AS_OF, history: int | None = None) -> Star:
    """Dimensions and fact; the user history (largest number of versions of one user) is
    measured once -- or given by a caller that can bound it more cheaply at the source -- and
    decides both the SCD2 window strategy and the as-of join strategy."""
    largest = None
    if mode == "intended":
        largest = history if history is not None else dims.history_size(user_feed)
    plain = None if largest is None else largest <= DEFAULT_MAX_GROUP_ROWS
    range_join = None if largest is None else largest <= dims.MAX_VERSIONS_FOR_RANGE_JOIN
    users, products, dates = keyed_dimensions(clean, raw, user_feed, mode, as_of, plain)
    return Star(build_fact(clean, users, products, dates, mode, range_join), users, products, dates)


def star_join(star: Star) -> DataFrame:
    """E5: inner joins on the three surrogate keys (rows with an unknown member drop out)."""
    users = star.users.drop("is_first") if "is_first" in star.users.columns else star.users
    users = users.select("user_sk", F.col("user_id").alias("dim_user_id"), "country")
    products = star.products.select("product_sk", F.col("product_id").alias("dim_product_id"), "category")
    return (star.fact.join(users, "user_sk").join(products, "product_sk").join(star.dates, "date_key"))


def unknown_member_counts(fact: DataFrame) -> DataFrame:
    """E3 check: rows per unmatched key."""
    return fact.agg(*[F.count_if(F.col(k) == config.UNKNOWN_SK).alias(f"unknown_{k}")
                      for k in ("user_sk", "date_key", "product_sk")], F.count(F.lit(1)).alias("fact_rows"))
