"""What bounds a task's memory when the log of a keyed table grows."""

import tempfile

from pyspark.sql import functions as F

from eventide.sinks import keyed
from eventide.sinks.keyed import KeyedTable


def test_a_task_resolves_a_bounded_share_of_the_log(spark, monkeypatch):
    table = KeyedTable(spark, tempfile.mkdtemp(prefix="keyed-"), ["user_id"])
    for batch, users in ((0, 100), (1, 60)):
        table.write(spark.range(users).select(F.col("id").alias("user_id"), F.lit(batch).alias("n")), batch)
    monkeypatch.setattr(keyed, "TASK_ROWS", 5)
    current = table.current()
    assert current.rdd.getNumPartitions() == 32  # 160 rows of the log
    assert {(r["user_id"], r["n"]) for r in current.collect()} == {(u, int(u < 60)) for u in range(100)}
