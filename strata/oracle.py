"""Independent SQL (DuckDB dialect) for the registered queries.

Written from the semantics, not from the Spark code: plain joins, GROUP BY and standard window
functions over the driver's tables. ``PREFIX`` defines every derived relation once as a CTE;
each query appends its final SELECT. CTE names avoid the driver's table names.
"""

from __future__ import annotations

from strata import config

AS_OF = config.TEST_AS_OF
CART = ", ".join(f"'{t}'" for t in config.TEST_CART_TYPES)
LOAD_TS = config.TEST_LOAD_TS

_CTES = {
    # ---- adapter: driver tables -> feed shapes ----------------------------------------------
    "nat": """SELECT c.c_custkey AS _uid, n.n_name AS country
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "ev0": f"""SELECT e.event_id AS _n, CAST(e.event_id AS VARCHAR) AS event_id,
            'user_' || CAST(e.user_id AS VARCHAR) AS user_id,
            'session_' || CAST(e.user_id AS VARCHAR) || '_' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS session_id,
            CAST(e.ts AS TIMESTAMP) AS event_time, e.event_type,
            'prod_' || json_extract_string(e.props, '$.k') AS product_id,
            p.p_type AS category,
            CASE e.event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
            u.country, e.value AS price,
            CASE WHEN e.event_type IN ({CART}) THEN CAST(e.event_id % 5 + 1 AS INTEGER) END AS quantity
        FROM events e
        LEFT JOIN nat u ON e.user_id = u._uid
        LEFT JOIN part p ON CAST(json_extract_string(e.props, '$.k') AS BIGINT) = p.p_partkey""",
    "cls0": f"""SELECT *, CASE WHEN _n % 67 = 0 THEN 'null_user' WHEN _n % 71 = 0 THEN 'null_product'
            WHEN _n % 37 = 0 THEN 'null_attribute' WHEN _n % 31 = 0 THEN 'dirty_type'
            WHEN _n % 7 = 0 AND event_type IN ({CART}) THEN 'bad_quantity'
            WHEN _n % 89 = 0 THEN 'future' WHEN _n % 33 = 0 THEN 'duplicate' END AS _cls
        FROM ev0""",
    "dirty1": """SELECT event_id,
            CASE WHEN _cls = 'null_user' THEN NULL ELSE user_id END AS user_id,
            session_id,
            CASE WHEN _cls = 'future' THEN event_time + to_days(CAST(_n % 326 + 40 AS INTEGER)) ELSE event_time END AS event_time,
            CASE WHEN _cls = 'dirty_type' THEN ' ' || upper(event_type) || ' ' ELSE event_type END AS event_type,
            CASE WHEN _cls = 'null_product' THEN NULL ELSE product_id END AS product_id,
            CASE WHEN _cls = 'null_attribute' AND _n % 3 = 2 THEN NULL ELSE category END AS category,
            CASE WHEN _cls = 'null_attribute' AND _n % 3 = 0 THEN NULL ELSE device END AS device,
            CASE WHEN _cls = 'null_attribute' AND _n % 3 = 1 THEN NULL ELSE country END AS country,
            price,
            CASE WHEN _cls = 'bad_quantity' THEN CAST((CASE _n % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -1 ELSE -3 END) AS INTEGER)
                 ELSE quantity END AS quantity,
            _cls
        FROM cls0""",
    "raw_ev": """SELECT * EXCLUDE (_cls) FROM dirty1
        UNION ALL SELECT * EXCLUDE (_cls) FROM dirty1 WHERE _cls = 'duplicate'""",
    "clean_view": "SELECT * EXCLUDE (_n) FROM ev0",
    "uf0": """SELECT e.user_id AS _u, e.ts, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS _k
        FROM events e WHERE e.event_type = 'signup'""",
    "uf_first": "SELECT _u, min(ts) AS _first_ts FROM uf0 GROUP BY _u",
    "user_feed": """SELECT 'user_' || CAST(a._u AS VARCHAR) AS user_id,
            'user_' || CAST(a._u AS VARCHAR) || '@example.com' AS email,
            n.country,
            CASE a._k % 4 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold' ELSE 'platinum' END AS loyalty_tier,
            CAST(f._first_ts AS DATE) AS signup_date,
            CAST(a.ts AS TIMESTAMP) AS updated_at,
            CASE WHEN a.ts = f._first_ts THEN 'insert' ELSE 'update' END AS change_type
        FROM uf0 a JOIN uf_first f ON a._u = f._u LEFT JOIN nat n ON a._u = n._uid""",
    # ---- cleaning ------------------------------------------------------------------------
    "norm_iw": """SELECT * REPLACE (lower(trim(event_type)) AS event_type, lower(trim(device)) AS device) FROM raw_ev""",
    "norm_aw": """SELECT * REPLACE (lower(trim(event_id)) AS event_id, lower(trim(user_id)) AS user_id,
            lower(trim(session_id)) AS session_id, lower(trim(event_type)) AS event_type,
            lower(trim(product_id)) AS product_id, lower(trim(category)) AS category,
            lower(trim(device)) AS device, lower(trim(country)) AS country) FROM raw_ev""",
    "kept_iw": f"""SELECT * FROM norm_iw
        WHERE user_id IS NOT NULL AND event_time IS NOT NULL AND session_id IS NOT NULL
          AND (quantity IS NULL OR quantity >= 0)
          AND NOT (coalesce(event_type IN ({CART}), false) AND (quantity IS NULL OR quantity <= 0))
          AND product_id IS NOT NULL
          AND TRY_CAST(price AS DOUBLE) > 0 AND TRY_CAST(price AS DOUBLE) < {config.MAX_PRICE}
          AND event_time <= TIMESTAMP '{AS_OF}'""",
    "dedup_iw": """SELECT DISTINCT ON (event_id) * REPLACE (coalesce(category, 'unknown') AS category,
            coalesce(country, 'unknown') AS country, coalesce(device, 'unknown') AS device)
        FROM kept_iw ORDER BY event_id""",
    "clean_iw": """SELECT event_id, user_id, session_id, event_time, CAST(event_time AS DATE) AS event_date,
            event_type, product_id, category, device, country, CAST(price AS DOUBLE) AS price,
            CAST(quantity AS INTEGER) AS quantity
        FROM dedup_iw""",
    "dedup_aw": """SELECT DISTINCT ON (event_id) * FROM norm_aw ORDER BY event_id""",
    "kept_aw": f"""SELECT * REPLACE (coalesce(category, 'unknown') AS category,
            coalesce(country, 'unknown') AS country, coalesce(device, 'unknown') AS device)
        FROM dedup_aw
        WHERE user_id IS NOT NULL AND event_time IS NOT NULL AND session_id IS NOT NULL
          AND NOT ((event_type IN ({CART}) AND quantity <= 0) OR quantity IS NULL)
          AND NOT (event_type IN ({CART}) AND product_id IS NULL)
          AND NOT (TRY_CAST(price AS DOUBLE) <= 0)
          AND event_time <= TIMESTAMP '{AS_OF}'""",
    "clean_aw": """SELECT coalesce(event_id, 'unknown') AS event_id, user_id, session_id, event_time,
            CAST(event_time AS DATE) AS event_date, event_type, product_id, category, device, country,
            CAST(price AS DOUBLE) AS price, CAST(quantity AS INTEGER) AS quantity
        FROM kept_aw""",
    "dedup_norm": "SELECT DISTINCT ON (event_id) * FROM norm_iw ORDER BY event_id",
    "bf_products": """SELECT product_id,
            max(CASE WHEN category IS NOT NULL THEN {'t': event_time, 'c': category} END).c AS category
        FROM dedup_norm WHERE product_id IS NOT NULL GROUP BY product_id""",
    # ---- users ---------------------------------------------------------------------------
    "uv": """SELECT DISTINCT ON (user_id, updated_at) user_id, updated_at, country, loyalty_tier
        FROM user_feed WHERE user_id IS NOT NULL AND updated_at IS NOT NULL
        ORDER BY user_id, updated_at, country NULLS FIRST, loyalty_tier NULLS FIRST""",
    "uv_l": """SELECT *, lag(updated_at) OVER w AS _pu, lag(country) OVER w AS _pc, lag(loyalty_tier) OVER w AS _pt
        FROM uv WINDOW w AS (PARTITION BY user_id ORDER BY updated_at)""",
    "uv_k": """SELECT user_id, country, loyalty_tier, updated_at, _pu IS NULL AS is_first FROM uv_l
        WHERE _pu IS NULL OR _pc IS DISTINCT FROM country OR _pt IS DISTINCT FROM loyalty_tier""",
    "scd2": """SELECT user_id, country, loyalty_tier, updated_at AS valid_from,
            lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS valid_to, is_first
        FROM uv_k""",
    "users_iw": """SELECT user_id, country, loyalty_tier, valid_from, valid_to, valid_to IS NULL AS is_current,
            is_first, row_number() OVER (ORDER BY user_id, valid_from) AS user_sk
        FROM scd2""",
    "ul0": """SELECT lower(trim(user_id)) AS user_id, lower(trim(country)) AS country, signup_date, updated_at
        FROM user_feed""",
    "ul1": """SELECT a.*, m._max_to FROM ul0 a
        LEFT JOIN (SELECT user_id, max(updated_at) AS _max_to FROM ul0 GROUP BY user_id) m ON a.user_id IS NOT DISTINCT FROM m.user_id""",
    "ul2": """SELECT coalesce(user_id, 'unknown') AS user_id, country,
            coalesce(signup_date, DATE '1970-01-01') AS effective_from, updated_at AS effective_to,
            coalesce(updated_at = _max_to, false) AS is_current
        FROM ul1""",
    "dim_user_latest": """SELECT DISTINCT ON (user_id, effective_from, effective_to) *
        FROM ul2 ORDER BY user_id, effective_from, effective_to, country NULLS FIRST, is_current NULLS FIRST""",
    "users_aw": """SELECT *, row_number() OVER (ORDER BY user_id, effective_from, effective_to) AS user_sk
        FROM dim_user_latest""",
    # ---- products and dates --------------------------------------------------------------------
    "products_iw": """SELECT product_id,
            max(CASE WHEN category IS NOT NULL THEN {'t': event_time, 'c': category} END).c AS category,
            coalesce(max(event_time), TIMESTAMP '1970-01-01 00:00:00') AS updated_ts,
            row_number() OVER (ORDER BY product_id) AS product_sk
        FROM clean_iw WHERE product_id IS NOT NULL GROUP BY product_id""",
    "pf0": f"""SELECT DISTINCT coalesce(product_id, 'unknown') AS product_id, category,
            coalesce(event_time, TIMESTAMP '{AS_OF}') AS updated_ts FROM raw_ev""",
    "pf1": """SELECT *, dense_rank() OVER (PARTITION BY product_id ORDER BY updated_ts) AS _r FROM pf0""",
    "dim_product_first4": """SELECT product_id, min(category) AS category, updated_ts
        FROM pf1 WHERE _r < 5 GROUP BY product_id, updated_ts""",
    "products_aw": """SELECT *, row_number() OVER (ORDER BY product_id, updated_ts) AS product_sk
        FROM dim_product_first4""",
    "dates_src_iw": "SELECT DISTINCT coalesce(CAST(event_time AS DATE), DATE '1970-01-01') AS full_date FROM clean_iw",
    "dates_src_aw": "SELECT DISTINCT coalesce(CAST(event_time AS DATE), DATE '1970-01-01') AS full_date FROM raw_ev",
    "dates_iw": """SELECT full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
            CAST(month(full_date) AS INTEGER) AS month, strftime(full_date, '%b') AS monthname,
            CAST(weekofyear(full_date) AS INTEGER) AS weekyear, CAST(isodow(full_date) - 1 AS INTEGER) AS weekday,
            strftime(full_date, '%a') AS dayname, CAST(day(full_date) AS INTEGER) AS day,
            (isodow(full_date) - 1) IN (5, 6) AS is_weekend,
            row_number() OVER (ORDER BY full_date) AS date_key
        FROM dates_src_iw""",
    "dates_aw": """SELECT full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
            CAST(month(full_date) AS INTEGER) AS month, strftime(full_date, '%b') AS monthname,
            CAST(weekofyear(full_date) AS INTEGER) AS weekyear, CAST(isodow(full_date) - 1 AS INTEGER) AS weekday,
            strftime(full_date, '%a') AS dayname, CAST(day(full_date) AS INTEGER) AS day,
            (isodow(full_date) - 1) IN (5, 6) AS is_weekend,
            row_number() OVER (ORDER BY full_date) AS date_key
        FROM dates_src_aw""",
    # ---- facts -----------------------------------------------------------------------------------
    "fact_iw": """SELECT c.event_id, c.event_time, c.event_date, c.event_type, c.user_id, c.product_id,
            coalesce(u.user_sk, -1) AS user_sk, coalesce(d.date_key, -1) AS date_key,
            coalesce(p.product_sk, -1) AS product_sk, c.session_id, c.device, c.price, c.quantity
        FROM clean_iw c
        LEFT JOIN users_iw u ON c.user_id = u.user_id
             AND (c.event_time >= u.valid_from OR u.is_first)
             AND (u.valid_to IS NULL OR c.event_time < u.valid_to)
        LEFT JOIN products_iw p ON c.product_id = p.product_id
        LEFT JOIN dates_iw d ON c.event_date = d.full_date""",
    "fact_aw": """SELECT c.event_id, c.event_time, c.event_date, c.event_type, c.user_id, c.product_id,
            coalesce(u.user_sk, -1) AS user_sk, coalesce(d.date_key, -1) AS date_key,
            coalesce(p.product_sk, -1) AS product_sk, c.session_id, c.device, c.price, c.quantity
        FROM clean_aw c
        LEFT JOIN users_aw u ON c.user_id = u.user_id
        LEFT JOIN dates_aw d ON c.event_date = d.full_date
        LEFT JOIN products_aw p ON c.product_id = p.product_id""",
    "live_iw": "SELECT * FROM fact_iw WHERE user_sk <> -1 AND date_key <> -1 AND product_sk <> -1",
    "star_aw": """SELECT f.*, u.user_id AS dim_user_id, u.country, p.product_id AS dim_product_id, p.category,
            d.full_date, d.year, d.quarter, d.month, d.monthname, d.weekyear, d.weekday, d.dayname, d.day, d.is_weekend
        FROM fact_aw f JOIN users_aw u ON f.user_sk = u.user_sk
        JOIN products_aw p ON f.product_sk = p.product_sk
        JOIN dates_aw d ON f.date_key = d.date_key""",
    "sales_iw": """SELECT *, CAST(price AS DECIMAL(18,6)) * CAST(coalesce(quantity, 0) AS DECIMAL(10,0)) AS _sale
        FROM live_iw WHERE event_type = 'purchase'""",
}

PREFIX = "WITH " + ",\n".join(f"{name} AS (\n{body}\n)" for name, body in _CTES.items()) + "\n"


def sql(select: str) -> str:
    return PREFIX + select


def money(expr: str) -> str:
    return f"CAST(round(sum(CAST({expr} AS DECIMAL(24,6))), 2) AS DOUBLE)"


def int_ratio(num: str, den: str, digits: int) -> str:
    """Half-up round(num/den, digits) on integers, mirroring the Spark side."""
    scale = 10 ** digits
    return (f"CASE WHEN ({den}) > 0 THEN CAST(((CAST({num} AS BIGINT) * {2 * scale} + ({den})) // (2 * ({den})))"
            f" AS DOUBLE) / {float(scale)} END")


def money_avg(total: str, n: str) -> str:
    """Half-up average of an exact total, in cents, on whole numbers."""
    return (f"CASE WHEN ({n}) > 0 THEN CAST((CAST(({total}) * 1000000 AS HUGEINT) * 2 + ({n}) * 10000) // (({n}) * 20000) AS DOUBLE)"
            " / 100.0 END")


def total(expr: str) -> str:
    return f"CAST(round(sum({expr}), 2) AS DOUBLE)"


def with_odd_prices(select: str) -> str:
    """``select`` over a feed whose prices are those of ``testdata.odd_prices``."""
    price = ("CASE CAST(event_id AS BIGINT) % 13 WHEN 0 THEN CAST('nan' AS DOUBLE) WHEN 1 THEN CAST('inf' AS DOUBLE) WHEN 2 THEN CAST('-inf' AS DOUBLE) "
             "WHEN 3 THEN 1e20 WHEN 4 THEN 1e9 WHEN 5 THEN 2.345 WHEN 6 THEN 0.005 ELSE price END")
    ctes = {**_CTES, "raw_ev": f"SELECT * REPLACE ({price} AS price) FROM ({_CTES['raw_ev']}) r"}
    return "WITH " + ",\n".join(f"{name} AS (\n{body}\n)" for name, body in ctes.items()) + "\n" + select
