"""Map the driver-generated tables onto the event and user contracts.

``events`` carries (event_id, ts, user_id, event_type, value, props); the
event contract wants user_id, product_id, action, timestamp and optional
device text. ``customer`` -> ``nation`` -> ``region`` gives the user
dimension (name, region). All mappings are column expressions, so scans keep
column pruning and filter push-down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def device_id_col() -> F.Column:
    """Optional device text built from the row: null for every tenth event,
    so the null-distinct natural key has null rows to keep."""
    return F.when(F.col("event_id") % 10 != 0, F.concat(F.lit("device_"), F.col("user_id").cast("string")))


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the event contract; ``timestamp`` and ``event_time`` stay
    ``timestamp_ntz`` (naive UTC), as stored."""
    use_utc(spark)
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.expr("try_cast(user_id AS int)").alias("user_id"),
        F.expr("try_cast(get_json_object(props, '$.k') AS int)").alias("product_id"),
        F.col("event_type").alias("action"),
        F.col("ts").alias("timestamp"),
        device_id_col().alias("device_id"),
        F.lit(None).cast("string").alias("device_type"),
        F.lit(None).cast("string").alias("location"),
        F.lit(None).cast("string").alias("user_segment"),
        F.lit(None).cast("string").alias("ip_address"),
        F.col("ts").alias("event_time"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two columns every windowed count needs: user_id and event_time."""
    use_utc(spark)
    ev = table(spark, sf_dir, "events")
    return ev.select(F.expr("try_cast(user_id AS int)").alias("user_id"), F.col("ts").alias("event_time"))


def users_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension (user_id, name, email, region, created_at) from all of
    customer, nation and region. Every tenth customer is keyed by its negated
    id, so that enrichment meets users that the dimension does not know."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key = F.expr("try_cast(c_custkey AS int)")
    return (
        cust.join(nation, cust.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.when(F.col("c_custkey") % 10 != 0, key).otherwise(-key).alias("user_id"),
            F.col("c_name").alias("name"),
            F.lit(None).cast("string").alias("email"),
            F.col("r_name").alias("region"),
            F.lit(None).cast("timestamp").alias("created_at"),
        )
    )
