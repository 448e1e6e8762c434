"""User dimension over JDBC.

Only the three columns enrichment needs are read, and a numeric
``partitionColumn`` splits the scan over executors when the table is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings


def jdbc_properties(settings: Settings) -> dict[str, str]:
    props = {}
    if settings.jdbc_user:
        props["user"] = settings.jdbc_user
    if settings.jdbc_password:
        props["password"] = settings.jdbc_password
    return props


def read_users(spark: SparkSession, settings: Settings, table: str = "users",
               partitions: int | None = None, lower: int | None = None,
               upper: int | None = None) -> DataFrame:
    """``users`` as (user_id, name, region, created_at); created_at falls back
    to the load time, like the store's column default."""
    reader = spark.read.format("jdbc").option("url", settings.jdbc_url).option(
        "dbtable", f"(SELECT user_id, name, region, created_at FROM {table}) AS users_dim")
    for k, v in jdbc_properties(settings).items():
        reader = reader.option(k, v)
    if partitions and lower is not None and upper is not None:
        reader = (reader.option("partitionColumn", "user_id").option("numPartitions", str(partitions))
                  .option("lowerBound", str(lower)).option("upperBound", str(upper)))
    return with_created_default(reader.load())


def with_created_default(users: DataFrame) -> DataFrame:
    """Column default of the store: a missing ``created_at`` is the load time."""
    return users.withColumn("created_at", F.coalesce(F.col("created_at"), F.current_timestamp()))
