"""Command line: run the streaming job or the alert notifier on a cluster.

    spark-submit --packages <kafka connector> -m eventide.app job
    spark-submit ... -m eventide.app notify
    spark-submit ... -m eventide.app tail [--records 10]

Settings come from the environment (see ``config.Settings.from_env``);
outputs go under OUTPUT_ROOT, checkpoints under CHECKPOINT_BASE or, when
unset, under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .operators.tail import LogTail
from .session import shared_dir
from .sinks.outputs import Outputs
from .sources.dimension import Dimension
from .sources.jdbc import read_users, with_created_default
from .sources.streams import alert_stream, event_stream
from .streaming.job import await_any, start_queries
from .streaming.notify import start_notifier


def cluster_session(app_name: str = "eventide") -> SparkSession:
    """Session for spark-submit: master and sizes come from the submit.

    Static broadcast decisions rest on file-size estimates, which are not a
    bound (compressed Parquet understates memory size), so they are off: a
    join side is broadcast only by AQE after the shuffle measured it below 64 MB."""
    spark = (SparkSession.builder.appName(app_name)
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
             .config("spark.sql.files.maxPartitionBytes", "256m")
             .config("spark.sql.parquet.compression.codec", "snappy")
             .config("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
             .getOrCreate())
    return spark


def checkpoint_root(spark: SparkSession, settings: Settings, name: str) -> str:
    base = settings.checkpoint_root or f"{shared_dir(spark).rstrip('/')}/streams"
    return f"{base.rstrip('/')}/{name}"


def users_source(spark: SparkSession, settings: Settings) -> Dimension:
    """The user dimension from Parquet or JDBC, read again as it ages."""
    if settings.users_path:
        def read() -> DataFrame:
            users = spark.read.parquet(settings.users_path)
            if "created_at" not in users.columns:
                users = users.withColumn("created_at", F.lit(None).cast("timestamp"))
            return with_created_default(users).select("user_id", "name", "region", "created_at")
    elif settings.jdbc_url:
        def read() -> DataFrame:
            return read_users(spark, settings)
    else:
        raise SystemExit("USERS_PATH or JDBC_URL is required")
    return Dimension(read, settings.users_refresh_seconds)


def outputs_of(spark: SparkSession, settings: Settings) -> Outputs:
    """Where the job writes: each kind of output is chosen on its own."""
    if not settings.output_root:
        raise SystemExit("OUTPUT_ROOT is required")
    raw_format = settings.raw_format or ("jdbc" if settings.jdbc_url else "parquet")
    if "jdbc" in (raw_format, settings.keyed_format) and not settings.jdbc_url:
        raise SystemExit("JDBC_URL is required to store over JDBC")
    return Outputs(spark, settings.output_root, settings, alert_format=settings.alert_format or "kafka",
                   raw_format=raw_format, keyed_format=settings.keyed_format)


def fix_state_partitions(spark: SparkSession, settings: Settings) -> None:
    """A query's state keeps the partitions of its first run for ever, so a
    cluster must say how many; the default of a shuffle is no choice."""
    if not settings.state_partitions:
        raise SystemExit("STATE_PARTITIONS is required (the queries' state keeps this number of partitions for ever)")
    spark.conf.set("spark.sql.shuffle.partitions", str(settings.state_partitions))


def run_job(spark: SparkSession, settings: Settings, source: DataFrame | None = None, wait=await_any):
    """Start the four queries on the event topic (or another stream of
    ``value``) and wait for any of them to end."""
    outputs, users = outputs_of(spark, settings), users_source(spark, settings)
    fix_state_partitions(spark, settings)
    queries = start_queries(spark, event_stream(spark, settings) if source is None else source, users, outputs, settings,
                            checkpoint_root(spark, settings, "job"))
    wait(spark)
    return outputs, queries


def run_notifier(spark: SparkSession, settings: Settings) -> None:
    if not settings.output_root:
        raise SystemExit("OUTPUT_ROOT is required")
    start_notifier(alert_stream(spark, settings), f"{settings.output_root.rstrip('/')}/notifications",
                   checkpoint_root(spark, settings, "notify"), settings.trigger)
    await_any(spark)


#: Tells any two records of the job's log apart, oldest first.
LOG_ORDER = ("logged_at", "source", "run", "batch_id", "type", "payload")


def log_tail(spark: SparkSession, settings: Settings, settle_seconds: float = 5.0) -> LogTail:
    """The job's raw_batch, agg_batch and anomaly records, with a cursor beside the checkpoints."""
    return LogTail(outputs_of(spark, settings).log_records(), checkpoint_root(spark, settings, "tail"), LOG_ORDER,
                   settle_seconds)


def show_tail(spark: SparkSession, settings: Settings, records: int) -> None:
    for r in log_tail(spark, settings).poll(records):
        print(f"[{r['logged_at'].isoformat()}] {json.dumps(json.loads(r['payload']), ensure_ascii=False)}")


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="eventide")
    parser.add_argument("command", choices=["job", "notify", "tail"])
    parser.add_argument("--records", type=int, default=10, help="records of a page of the log")
    args = parser.parse_args(argv)
    settings = Settings.from_env()
    spark = cluster_session()
    if args.command == "job":
        run_job(spark, settings)
    elif args.command == "notify":
        run_notifier(spark, settings)
    else:
        show_tail(spark, settings, args.records)


if __name__ == "__main__":
    main()
