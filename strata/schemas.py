"""Schemas of the feeds (bronze) and the star schema (silver)."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw clickstream feed as it lands (newline-delimited JSON). Times stay strings in bronze so a
# malformed value is kept and sent to quarantine in silver instead of failing the read.
CLICKSTREAM_FEED = StructType([
    StructField("event_id", StringType()),
    StructField("user_id", StringType()),
    StructField("session_id", StringType()),
    StructField("event_time", StringType()),
    StructField("event_type", StringType()),
    StructField("product_id", StringType()),
    StructField("category", StringType()),
    StructField("device", StringType()),
    StructField("country", StringType()),
    StructField("price", DoubleType()),
    StructField("quantity", IntegerType()),
])

# Cleaned, typed events (silver input to the fact).
SILVER_EVENTS = StructType([
    StructField("event_id", StringType(), nullable=False),
    StructField("user_id", StringType(), nullable=False),
    StructField("session_id", StringType(), nullable=False),
    StructField("event_time", TimestampType(), nullable=False),
    StructField("event_date", DateType()),
    StructField("event_type", StringType()),
    StructField("product_id", StringType()),
    StructField("category", StringType()),
    StructField("device", StringType()),
    StructField("country", StringType()),
    StructField("price", DoubleType()),
    StructField("quantity", IntegerType()),
])

# User dimension as the batch job writes it (latest-flag form).
DIM_USER_LATEST = StructType([
    StructField("user_id", StringType(), nullable=False),
    StructField("country", StringType()),
    StructField("effective_from", DateType(), nullable=False),
    StructField("effective_to", TimestampType()),
    StructField("is_current", BooleanType()),
])

# User dimension as a true type-2 history.
DIM_USER_SCD2 = StructType([
    StructField("user_id", StringType(), nullable=False),
    StructField("country", StringType()),
    StructField("loyalty_tier", StringType()),
    StructField("valid_from", TimestampType(), nullable=False),
    StructField("valid_to", TimestampType()),
    StructField("is_current", BooleanType(), nullable=False),
])

DIM_PRODUCT = StructType([
    StructField("product_id", StringType(), nullable=False),
    StructField("category", StringType()),
    StructField("updated_ts", TimestampType(), nullable=False),
])

DIM_DATE = StructType([
    StructField("full_date", DateType(), nullable=False),
    StructField("year", IntegerType()),
    StructField("quarter", IntegerType()),
    StructField("month", IntegerType()),
    StructField("monthname", StringType()),
    StructField("weekyear", IntegerType()),
    StructField("weekday", IntegerType()),
    StructField("dayname", StringType()),
    StructField("day", IntegerType()),
    StructField("is_weekend", BooleanType(), nullable=False),
])

FACT_EVENTS = StructType([
    StructField("event_id", StringType(), nullable=False),
    StructField("event_time", TimestampType(), nullable=False),
    StructField("event_date", DateType()),
    StructField("event_type", StringType()),
    StructField("user_id", StringType()),
    StructField("product_id", StringType()),
    StructField("user_sk", LongType(), nullable=False),
    StructField("date_key", LongType(), nullable=False),
    StructField("product_sk", LongType(), nullable=False),
    StructField("session_id", StringType()),
    StructField("device", StringType()),
    StructField("price", DoubleType()),
    StructField("quantity", IntegerType()),
])


def ddl(schema: StructType) -> str:
    """Column list for ``CREATE TABLE`` from a StructType."""
    parts = []
    for f in schema.fields:
        null = "" if f.nullable else " NOT NULL"
        parts.append(f"{f.name} {f.dataType.simpleString().upper()}{null}")
    return ", ".join(parts)
