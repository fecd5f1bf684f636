"""Fixed values and default parameters.

Fixed values that must equal the behaviour being reproduced are listed together below, as
plain text, in their natural order.
"""

from __future__ import annotations

# ---- fixed values -------------------------------------------------------------------------
# Event types that carry a quantity in the clickstream feed (cart-type events).
FEED_CART_TYPES = ("add_to_cart", "purchase", "checkout")
# Funnel steps in the order a session walks them in the feed.
FEED_FUNNEL_STEPS = ("page_view", "product_view", "add_to_cart", "checkout", "purchase")
# Categorical columns filled with a placeholder when null, and the placeholder.
FILL_COLUMNS = ("category", "country", "device")
UNKNOWN = "unknown"
# Columns an event cannot be attributed without.
REQUIRED_EVENT_COLUMNS = ("user_id", "event_time", "session_id")
# String columns whose case/whitespace is dirty in the feed (intended normalisation).
DIRTY_STRING_COLUMNS = ("event_type", "device")
# Surrogate key of the unknown dimension member.
UNKNOWN_SK = -1
# Loyalty tiers of the user change feed.
LOYALTY_TIERS = ("bronze", "silver", "gold", "platinum")
# Devices of the clickstream feed.
DEVICES = ("mobile", "desktop", "tablet")
# Weekend days as Spark ``weekday`` numbers (Monday = 0).
WEEKEND_WEEKDAYS = (5, 6)
# Default for a missing date / timestamp when a column must be non-null.
DEFAULT_DATE = "1970-01-01"
DEFAULT_TIMESTAMP = "1970-01-01 00:00:00"
# Formatted-number pattern used by the notebook's quantity parse.
QUANTITY_NUMBER_FORMAT = "99"
# ISO-8601 layout the feed writes event and change times in (microseconds, numeric offset).
FEED_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# -------------------------------------------------------------------------------------------

# Parameters for the driver's test tables (see strata.sources.testdata).
TEST_CART_TYPES = ("click", "purchase")
TEST_FUNNEL_STEPS = ("view", "click", "purchase")
# Reference "now" for the test tables: events span 2024-01-01..2024-01-30.
TEST_AS_OF = "2024-02-01 00:00:00"
# Load time stamped on bronze rows built from the test tables (reproducible runs).
TEST_LOAD_TS = "2024-02-01 00:00:00"

# A price from here on is no amount of money (a broken feed); keeps sums within their decimals.
MAX_PRICE = 1_000_000_000

MODES = ("intended", "as_written")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode
