"""Keyed outputs: the changes of each micro-batch, and the current rows as a view.

Plain files have no keyed write, so each micro-batch is appended as its own
partition (see ``batches``) and reading takes, per key, the row of the newest
batch (upsert) or of the oldest (insert-ignore): ``max_by`` or ``min_by`` on the
batch's version, with fixed-width values a hash aggregate. A key occurs once in
a batch, so there is little to combine before the shuffle, and no key is in more
rows than there are batches: rows are dealt on the key first, into as many
partitions as keep the aggregate of a task bounded. Where a catalog has tables that take row changes,
``merge_into`` does the same with one MERGE per micro-batch.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import PARTITIONS, read_batches, write_batch
from .runs import version


#: Rows of the log, on average, that one task resolves.
TASK_ROWS = 500_000


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], keep: str = "last",
                 schema: T.StructType | None = None, run: int = 0):
        if keep not in ("last", "first"):
            raise ValueError("keep must be 'last' (upsert) or 'first' (insert-ignore)")
        self.spark, self.path, self.keys, self.keep = spark, path, list(keys), keep
        self.schema, self.run = schema, run

    def write(self, batch: DataFrame, batch_id: int, tag: str = "main") -> None:
        write_batch(batch, self.path, tag, batch_id, run=self.run)

    def log(self) -> DataFrame:
        """Every written row with its ``source`` tag, ``run`` and ``batch_id``;
        empty (with the table schema) before the first non-empty batch."""
        full = None
        if self.schema is not None:
            full = T.StructType(self.schema.fields + [T.StructField("source", T.StringType()),
                                                      T.StructField("run", T.LongType()),
                                                      T.StructField("batch_id", T.LongType())])
        try:
            return read_batches(self.spark, self.path, schema=full)
        except AnalysisException as e:
            if full is None or e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], full)

    def current(self, tag: str | None = None) -> DataFrame:
        log = self.log()
        if tag is not None:
            log = log.filter(F.col("source") == tag)
        values = [c for c in log.columns if c not in self.keys and c not in PARTITIONS]
        best = F.max_by if self.keep == "last" else F.min_by
        # the number of rows is in the files' footers
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-log.count() // TASK_ROWS))
        return log.repartition(tasks, *self.keys).groupBy(*self.keys).agg(*[best(F.col(c), version()).alias(c) for c in values])


def merge_into(batch: DataFrame, table: str, keys: Sequence[str], keep: str = "last") -> None:
    """One MERGE of a micro-batch into a catalog table whose format takes row
    changes (plain Parquet tables do not). A replayed batch changes nothing."""
    on = None
    for k in keys:
        same = F.col(f"{table}.{k}") == F.col(f"batch.{k}")
        on = same if on is None else on & same
    merge = batch.alias("batch").mergeInto(table, on)
    if keep == "last":
        merge = merge.whenMatched().updateAll()
    merge.whenNotMatched().insertAll().merge()
