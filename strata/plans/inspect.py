"""Plan inspection helpers: what the optimizer actually chose, for tests and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The executed physical plan as text (AQE's initial plan when not yet run)."""
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df: DataFrame) -> str:
    """``explain("formatted")`` output as a string."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def count_operator(df: DataFrame, name: str) -> int:
    return physical_plan(df).count(name)


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the plan (each one is a full data movement)."""
    return count_operator(df, "Exchange hashpartitioning") + count_operator(df, "Exchange rangepartitioning") \
        + count_operator(df, "Exchange SinglePartition")


def pushed_filters(df: DataFrame) -> list[str]:
    out = []
    for line in physical_plan(df).splitlines():
        if "PushedFilters:" in line:
            out.append(line.split("PushedFilters:", 1)[1].split("]", 1)[0] + "]")
    return out
