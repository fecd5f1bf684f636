"""Data quality operators: normalise, dedupe, profile, fill, validate, quarantine.

Every operator is a ``DataFrame -> DataFrame`` function with no action inside. Rules whose
as-written and intended behaviour differ take ``mode`` (``"intended"`` default).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import config
from strata.functions.columns import string_columns

TIME_STRING_COLUMNS = ("event_time", "updated_at", "signup_date", "ingestion_ts")


# ---- C1 / B2: string normalisation ---------------------------------------------------------
def normalize_strings(df: DataFrame, mode: str = "intended", columns=None) -> DataFrame:
    """trim + lower in one projection over many columns.

    ``intended``: the feed's dirty columns only (event_type, device).
    ``as_written``: every string column; time strings are only trimmed (lower-casing the ``T``
    of an ISO time breaks parsing, the original round-trips it through ``upper``).
    """
    config.check_mode(mode)
    strings = set(string_columns(df))
    if columns is None:
        columns = config.DIRTY_STRING_COLUMNS if mode == "intended" else [c for c in df.columns if c in strings]
    exprs = {}
    for c in columns:
        if c not in strings:
            continue
        exprs[c] = F.expr(f"upper(trim(`{c}`))" if c in TIME_STRING_COLUMNS else f"lower(trim(`{c}`))")
    return df.withColumns(exprs) if exprs else df


# ---- C2 / C3: dedupe -----------------------------------------------------------------------
def dedupe(df: DataFrame, keys) -> DataFrame:
    """One row per key, deterministically the smallest remaining row.

    Planned as a partial + final aggregate on the keys, so a key repeated across the whole
    input is combined map-side before the shuffle (skew-safe), unlike a window.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("dedupe needs at least one key column")
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    row = ", ".join(f"`{c}`" for c in rest)
    picked = df.groupBy(*keys).agg(F.expr(f"min(struct({row})) AS _row"))
    return picked.selectExpr(*[f"`{k}`" for k in keys], "_row.*").select(*df.columns)


# ---- C4: distinct ----------------------------------------------------------------------------
def distinct_values(df: DataFrame, columns) -> DataFrame:
    return df.select(*columns).distinct()


# ---- C5: null profile ------------------------------------------------------------------------
def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column in a single global aggregate (one job, one scan)."""
    return df.agg(*[F.expr(f"count_if(`{c}` IS NULL) AS `{c}`") for c in df.columns])


# ---- C6 / C7: fill and drop ------------------------------------------------------------------
def fill_unknown(df: DataFrame, columns=config.FILL_COLUMNS, value: str = config.UNKNOWN) -> DataFrame:
    return df.fillna(value, subset=[c for c in columns if c in df.columns])


def drop_required_nulls(df: DataFrame, columns=config.REQUIRED_EVENT_COLUMNS) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


# ---- C8 / C8b / C9: quantity validity ---------------------------------------------------------
def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def quantity_sql(rule: str = "intended", cart_types=config.FEED_CART_TYPES) -> str:
    """Keep-condition for the quantity rule (rows where it is not TRUE are dropped).

    as_written: NOT ((cart AND q <= 0) OR q IS NULL) -- drops every null quantity.
    notebook:   NOT (cart AND q <= 0 AND q IS NULL)  -- drops only null quantity on cart types
                (the AND evaluates to NULL there).
    intended:   negatives dropped everywhere; null or 0 dropped on cart types only.
    """
    cart = f"event_type IN ({_in(cart_types)})"
    if rule == "as_written":
        return f"NOT (({cart} AND quantity <= 0) OR quantity IS NULL)"
    if rule == "notebook":
        return f"NOT ({cart} AND quantity <= 0 AND quantity IS NULL)"
    if rule == "intended":
        return (f"((quantity IS NULL OR quantity >= 0) AND "
                f"NOT (coalesce({cart}, false) AND (quantity IS NULL OR quantity <= 0)))")
    raise ValueError(f"unknown quantity rule {rule!r}")


def quantity_condition(rule: str = "intended", cart_types=config.FEED_CART_TYPES) -> Column:
    return F.expr(quantity_sql(rule, cart_types))


def filter_quantity(df: DataFrame, rule: str = "intended", cart_types=config.FEED_CART_TYPES) -> DataFrame:
    return df.filter(quantity_condition(rule, cart_types))


# ---- C10: product required -------------------------------------------------------------------
def product_sql(mode: str = "intended", cart_types=config.FEED_CART_TYPES) -> str:
    """as_written: a cart-type event needs a product (a null type with null product is dropped
    too, by three-valued logic). intended: an event without a product cannot be attributed."""
    config.check_mode(mode)
    if mode == "as_written":
        return f"NOT (event_type IN ({_in(cart_types)}) AND product_id IS NULL)"
    return "product_id IS NOT NULL"


def product_condition(mode: str = "intended", cart_types=config.FEED_CART_TYPES) -> Column:
    return F.expr(product_sql(mode, cart_types))


def filter_product(df: DataFrame, mode: str = "intended", cart_types=config.FEED_CART_TYPES) -> DataFrame:
    return df.filter(product_condition(mode, cart_types))


# ---- C11: positive price ---------------------------------------------------------------------
def price_sql(mode: str = "intended") -> str:
    """as_written: drops price <= 0, null and unparseable (the comparison is NULL there), which keeps NaN and
    infinity. intended: an amount of money above 0 and below ``MAX_PRICE``; NaN compares as the greatest number."""
    config.check_mode(mode)
    if mode == "as_written":
        return "NOT (try_cast(price AS DOUBLE) <= 0)"
    return f"(try_cast(price AS DOUBLE) > 0 AND try_cast(price AS DOUBLE) < {config.MAX_PRICE}d)"


def filter_positive_price(df: DataFrame, mode: str = "as_written") -> DataFrame:
    return df.filter(F.expr(price_sql(mode)))


# ---- C12 / C13: time ---------------------------------------------------------------------------
def time_sql(as_of: str, column: str = "event_time") -> str:
    return f"`{column}` <= TIMESTAMP '{as_of}'"


def time_condition(as_of: str, column: str = "event_time") -> Column:
    return F.expr(time_sql(as_of, column))


def drop_future(df: DataFrame, as_of: str, column: str = "event_time") -> DataFrame:
    """Keep events at or before ``as_of`` (a parameter, so reruns are reproducible)."""
    return df.filter(time_condition(as_of, column))


def time_range(df: DataFrame, as_of: str, column: str = "event_time") -> DataFrame:
    return df.agg(F.expr(f"min(`{column}`) AS min_event_time"), F.expr(f"max(`{column}`) AS max_event_time"),
                  F.expr(f"max(CASE WHEN {time_sql(as_of, column)} THEN `{column}` END) AS max_event_time_kept"))


# ---- C14: offenders --------------------------------------------------------------------------
def offenders(df: DataFrame, cart_types=config.FEED_CART_TYPES, fill_columns=config.FILL_COLUMNS) -> DataFrame:
    """Rows that break an expectation, one row per (event, reason), in a single scan."""
    checks = [
        ("before_1970", "event_time < TIMESTAMP '1970-01-01 00:00:00'"),
        ("cart_missing_value", f"event_type IN ({_in(cart_types)}) AND (product_id IS NULL OR quantity IS NULL)"),
        ("null_attribute", " OR ".join(f"`{c}` IS NULL" for c in fill_columns)),
    ]
    arr = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in checks)
    return df.selectExpr("event_id", "event_type", "product_id", "quantity",
                         f"explode(array_compact(array({arr}))) AS reason")


# ---- C16: anomaly report -----------------------------------------------------------------------
def anomaly_report(df: DataFrame, as_of: str, cart_types=config.FEED_CART_TYPES) -> DataFrame:
    """Counts of the six anomaly classes of the feed in one pass (plus one distinct on event_id)."""
    dirty = " OR ".join(f"coalesce(`{c}` <> lower(trim(`{c}`)), false)" for c in config.DIRTY_STRING_COLUMNS)
    nulls = " OR ".join(f"`{c}` IS NULL" for c in config.FILL_COLUMNS)
    return df.agg(
        F.expr("count(1) AS total_rows"),
        F.expr("count_if(user_id IS NULL OR product_id IS NULL) AS null_user_or_product"),
        F.expr(f"count_if({nulls}) AS null_device_country_category"),
        F.expr("count(1) - count(DISTINCT event_id) AS duplicate_events"),
        F.expr(f"count_if(lower(trim(event_type)) IN ({_in(cart_types)}) AND (quantity IS NULL OR quantity <= 0)) "
               "AS invalid_quantity"),
        F.expr(f"count_if(event_time > TIMESTAMP '{as_of}') AS future_event_time"),
        F.expr(f"count_if({dirty}) AS dirty_strings"),
    )


# ---- C17: quarantine ---------------------------------------------------------------------------
def reject_reasons(as_of: str, cart_types=config.FEED_CART_TYPES) -> Column:
    """Comma-joined reason codes under the intended rules; NULL when the row is kept."""
    checks = [
        ("null_user", "user_id IS NULL"),
        ("null_session", "session_id IS NULL"),
        ("null_event_time", "event_time IS NULL"),
        ("null_product", "product_id IS NULL"),
        ("invalid_quantity", f"NOT coalesce({quantity_sql('intended', cart_types)}, false)"),
        ("non_positive_price", "NOT coalesce(try_cast(price AS DOUBLE) > 0, false)"),
        ("price_out_of_range", f"coalesce(try_cast(price AS DOUBLE) >= {config.MAX_PRICE}d, false)"),
        ("future_event", f"coalesce(event_time > TIMESTAMP '{as_of}', false)"),
    ]
    arr = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in checks)
    return F.expr(f"nullif(array_join(array_compact(array({arr})), ','), '')")


def quarantine(df: DataFrame, as_of: str, cart_types=config.FEED_CART_TYPES) -> DataFrame:
    """Every row with its reject reason (NULL = kept). Split with ``split_quarantine``.

    Run on deduped rows. With exact-copy duplicates (the feed's kind) the kept side equals the
    intended cleaning; with non-identical duplicates, cleaning keeps a valid copy (it filters
    before it dedupes) while this judges the deduped representative."""
    return df.withColumn("reject_reason", reject_reasons(as_of, cart_types))


def split_quarantine(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    kept = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = marked.filter(F.col("reject_reason").isNotNull())
    return kept, rejected


# ---- B8: formatted number parse --------------------------------------------------------------
def parse_quantity(df: DataFrame, column: str = "quantity") -> DataFrame:
    """``try_to_number(q, '99')``: two unsigned digits, NULL (not an error) otherwise."""
    return df.withColumn(column, F.try_to_number(F.col(column).cast("string"), F.lit(config.QUANTITY_NUMBER_FORMAT)))
