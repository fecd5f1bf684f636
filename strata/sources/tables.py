"""Catalog: database and external tables at stable locations.

Tables are registered ``USING <format> LOCATION '<path>'``, so a new session re-registers the
same data by running the same DDL; nothing depends on a session-local catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata import schemas


def ensure_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def ensure_table(spark: SparkSession, qualified: str, schema: StructType, location: str,
                 fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified} ({schemas.ddl(schema)}) USING {fmt}{parts} "
              f"LOCATION '{location}'")


def append_to_table(df: DataFrame, qualified: str) -> None:
    """Append to a catalog table; columns are matched by name (``insertInto`` itself is
    positional) and errors propagate (a failed load must fail the job)."""
    target_cols = df.sparkSession.table(qualified).columns
    df.select(*target_cols).write.mode("append").insertInto(qualified)


def save_bucketed(df: DataFrame, qualified: str, key: str, buckets: int, location: str) -> None:
    """Replace a table by ``df`` in buckets of ``key``, sorted inside; rows are dealt like the buckets first, so each is one file."""
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", location).bucketBy(buckets, key).sortBy(key).saveAsTable(qualified)


def scan(spark: SparkSession, qualified: str) -> DataFrame:
    """``SELECT * FROM table``."""
    return spark.sql(f"SELECT * FROM {qualified}")


def describe(spark: SparkSession, qualified: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {qualified}")
