"""JDBC store: every micro-batch is staged, then committed once.

Rows go out from the executors (``batchsize`` rows per round trip, one
connection per partition) into a staging table, never through the driver. One
transaction in the database then records the batch (target, run, batch id) and
merges the staging table, so a replayed batch is recognised and changes nothing
(rows with a null in their key too, which no key constraint catches), and a key
conflict is resolved by the store instead of failing a chunk.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

from ..config import Settings
from ..sources.jdbc import jdbc_properties


def write_options(settings: Settings, max_connections: int | None = None) -> dict[str, str]:
    opts = {"url": settings.jdbc_url, "batchsize": str(settings.raw_write_batch_rows)}
    opts.update(jdbc_properties(settings))
    if max_connections:
        opts["numPartitions"] = str(max_connections)
    return opts


def merge_statement(table: str, staging: str, keys: Sequence[str], values: Sequence[str],
                    keep: str = "last") -> str:
    """Standard SQL MERGE of ``staging`` into ``table`` on ``keys``."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    cols = list(keys) + list(values)
    insert = (f"WHEN NOT MATCHED THEN INSERT ({', '.join(cols)}) "
              f"VALUES ({', '.join('s.' + c for c in cols)})")
    if keep == "last":
        update = "WHEN MATCHED THEN UPDATE SET " + ", ".join(f"{v} = s.{v}" for v in values) + " "
        return f"MERGE INTO {table} t USING {staging} s ON {on} {update}{insert}"
    return f"MERGE INTO {table} t USING {staging} s ON {on} {insert}"


#: Table of committed batches; its key is (target, run, batch_id).
COMMITS = "committed_batches"


def record_statement(target: str, run: int, batch_id: int) -> str:
    """Record a batch unless it is there; the number of rows it inserts tells."""
    values = f"'{target}', {int(run)}, {int(batch_id)}"
    return (f"INSERT INTO {COMMITS} (target, run, batch_id) SELECT {values} WHERE NOT EXISTS (SELECT 1 FROM {COMMITS} "
            f"WHERE target = '{target}' AND run = {int(run)} AND batch_id = {int(batch_id)})")


def connect(rows: DataFrame, settings: Settings):
    """A connection of the driver's JVM (for the two statements only)."""
    jvm = rows.sparkSession.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in jdbc_properties(settings).items():
        props.setProperty(k, v)
    return jvm.java.sql.DriverManager.getConnection(settings.jdbc_url, props)


def stage(rows: DataFrame, settings: Settings, staging: str, max_connections: int | None = 8) -> None:
    rows.write.format("jdbc").options(**write_options(settings, max_connections)).option("dbtable", staging).option(
        "truncate", "true").mode("overwrite").save()


def commit_batch(rows: DataFrame, settings: Settings, table: str, keys: Sequence[str], target: str, run: int,
                 batch_id: int, keep: str = "last", connection=None, staged=stage) -> bool:
    """Stage the batch, then record and merge it in one transaction; False if
    it was committed before. (Needs a database; tests pass a stand-in for the
    connection and the staging.)"""
    staging = f"{target}_staging"
    staged(rows, settings, staging)
    values = [c for c in rows.columns if c not in keys]
    conn = connection or connect(rows, settings)
    try:
        conn.setAutoCommit(False)
        statement = conn.createStatement()
        new = statement.executeUpdate(record_statement(target, run, batch_id)) == 1
        if new:
            statement.executeUpdate(merge_statement(table, staging, keys, values, keep))
        conn.commit()
        statement.close()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()
    return new
