"""Silver event cleaning: the composed pipeline (C15) and schema conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from strata import config, schemas
from strata.functions.columns import as_timestamp, ts_lit
from strata.operators import quality

STAMP_COLUMNS = ("ingestion_ts", "ip_file_name")


def conform_events(df: DataFrame) -> DataFrame:
    """Typed, ordered, nullability-checked events (``DataFrame.to`` raises on a mismatch).

    Strings are parsed with ``try_*`` so a bad value becomes NULL instead of failing the job
    (ANSI stays on); required columns are coalesced to typed defaults first, which is what lets
    ``to`` accept them as non-nullable.
    """
    ts = as_timestamp(df, "event_time")
    stamps = [c for c in STAMP_COLUMNS if c in df.columns]
    typed = df.withColumn("_ts", F.coalesce(ts, ts_lit(config.DEFAULT_TIMESTAMP))).selectExpr(
        f"coalesce(CAST(event_id AS STRING), '{config.UNKNOWN}') AS event_id",
        f"coalesce(user_id, '{config.UNKNOWN}') AS user_id",
        f"coalesce(session_id, '{config.UNKNOWN}') AS session_id",
        "_ts AS event_time",
        "to_date(_ts) AS event_date",
        "event_type", "product_id", "category", "device", "country",
        "try_cast(price AS DOUBLE) AS price",
        "try_cast(quantity AS INT) AS quantity",
        *(["CAST(ingestion_ts AS TIMESTAMP) AS ingestion_ts"] if "ingestion_ts" in stamps else []),
        *(["ip_file_name"] if "ip_file_name" in stamps else []),
    )
    extra = [StructField("ingestion_ts", TimestampType()) if c == "ingestion_ts" else StructField(c, StringType())
             for c in stamps]
    target = StructType(list(schemas.SILVER_EVENTS.fields) + extra)
    return typed.to(target)


def keep_condition(mode: str, as_of: str, cart_types=config.FEED_CART_TYPES):
    """All row rules of one mode fused into a single predicate (one Filter, pushed to the scan
    where its parts are pushable)."""
    config.check_mode(mode)
    rule = "intended" if mode == "intended" else "as_written"
    parts = [f"`{c}` IS NOT NULL" for c in config.REQUIRED_EVENT_COLUMNS]
    parts += [quality.quantity_sql(rule, cart_types), quality.product_sql(mode, cart_types), quality.price_sql(mode),
              quality.time_sql(as_of)]
    return F.expr(" AND ".join(f"({p})" for p in parts))


def clean_events(df: DataFrame, mode: str = "intended", as_of: str = config.TEST_AS_OF,
                 cart_types=config.FEED_CART_TYPES) -> DataFrame:
    """Bronze events -> cleaned, typed silver events.

    intended:   normalise dirty strings -> drop invalid rows -> fill 'unknown' -> dedupe on
                event_id -> conform. Filtering before the dedupe shrinks the dedupe shuffle; it
                is equivalent because duplicates in the feed are exact copies.
    as_written: normalise every string -> dedupe -> fill -> drop nulls -> as-written quantity
                and product rules -> price -> future -> conform (the original order).
    """
    config.check_mode(mode)
    df = quality.normalize_strings(df, mode)
    df = df.withColumn("event_time", as_timestamp(df, "event_time"))
    if mode == "intended":
        df = df.filter(keep_condition(mode, as_of, cart_types))
        df = quality.fill_unknown(df)
        df = quality.dedupe(df, ["event_id"])
    else:
        df = quality.dedupe(df, ["event_id"])
        df = quality.fill_unknown(df)
        df = quality.drop_required_nulls(df)
        df = quality.filter_quantity(df, "as_written", cart_types)
        df = quality.filter_product(df, "as_written", cart_types)
        df = quality.filter_positive_price(df)
        df = quality.drop_future(df, as_of)
    return conform_events(df)
