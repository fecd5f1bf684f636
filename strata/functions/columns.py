"""Column expressions shared by the operators. All are Spark built-ins (codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from strata import config


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def dtype_of(df: DataFrame, name: str):
    return df.schema[name].dataType


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Typed timestamp from a string (either ISO form, with or without fraction) or a timestamp.

    ``try_to_timestamp`` without a pattern accepts ``...T21:10:09+00:00`` and
    ``...T21:10:09.101217+00:00`` alike and yields null (not an error) on garbage.
    """
    t = dtype_of(df, name)
    if isinstance(t, StringType):
        return F.try_to_timestamp(F.col(name))
    if isinstance(t, (TimestampType, TimestampNTZType, DateType)):
        return F.col(name).cast("timestamp")
    return F.col(name).try_cast("timestamp")


def as_date(df: DataFrame, name: str) -> Column:
    t = dtype_of(df, name)
    if isinstance(t, DateType):
        return F.col(name)
    if isinstance(t, StringType):
        return F.to_date(F.try_to_timestamp(F.col(name)))
    return F.to_date(F.col(name))


def money_sum(c: str) -> Column:
    """Exact, order-independent sum of a money column, rounded once, at the end; as double."""
    return F.expr(f"CAST(round(sum(CAST(`{c}` AS DECIMAL(24,6))), 2) AS DOUBLE)")


def calendar(date_col: str) -> dict[str, Column]:
    """Calendar attributes of a date column (Spark conventions: weekday Monday = 0, ISO week)."""
    d = f"`{date_col}`"
    weekend = ", ".join(str(w) for w in config.WEEKEND_WEEKDAYS)
    return {
        "year": F.expr(f"year({d})"),
        "quarter": F.expr(f"quarter({d})"),
        "month": F.expr(f"month({d})"),
        "monthname": F.expr(f"monthname({d})"),
        "weekyear": F.expr(f"weekofyear({d})"),
        "weekday": F.expr(f"weekday({d})"),
        "dayname": F.expr(f"dayname({d})"),
        "day": F.expr(f"dayofmonth({d})"),
        "is_weekend": F.expr(f"coalesce(weekday({d}) IN ({weekend}), false)"),
    }


def ts_lit(value: str) -> Column:
    """Non-null timestamp literal (a cast string literal is nullable, which ``DataFrame.to``
    rejects for a NOT NULL column); the text is read as UTC."""
    import datetime as _dt

    return F.lit(_dt.datetime.fromisoformat(value).replace(tzinfo=_dt.timezone.utc))


def date_lit(value: str) -> Column:
    import datetime as _dt

    return F.lit(_dt.date.fromisoformat(value))
