"""Run numbers: which life of a checkpoint wrote a batch.

Batch ids count from 0 in every checkpoint. When a checkpoint is lost, a new
job would write batch 0 over the old batch 0. So each checkpoint gets a run
number, kept beside it, from a ledger kept beside the outputs; every output is
keyed by (run, batch). A job whose checkpoint was replaced while it still runs
finds a newer number in the ledger and stops instead of writing."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Batch ids a run may have; version = run * BATCHES + batch_id orders all batches of all runs.
BATCHES = 1 << 40


class StaleRun(RuntimeError):
    """A newer run writes to the same outputs."""


def version(run: Column | str = "run", batch_id: Column | str = "batch_id") -> Column:
    """Order of a written row's batch among all batches, as one number."""
    run, batch_id = (F.col(c) if isinstance(c, str) else c for c in (run, batch_id))
    return run.cast("long") * BATCHES + batch_id.cast("long")


class Folder:
    """A folder on the file system that the job writes to."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._jvm, self._conf = jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self.path.getFileSystem(self._conf)

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.path, name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._child(name))

    def create(self, name: str) -> bool:
        """Make an empty file; False if it was there (atomic)."""
        self._fs.mkdirs(self.path)
        return self._fs.createNewFile(self._child(name))

    def names(self) -> list[str]:
        if not self._fs.exists(self.path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self.path)]


LEDGER = "_runs"


def claim_run(spark: SparkSession, root: str, checkpoint: str) -> int:
    """The run number of ``checkpoint``: the one it has, or the next free one of
    the ledger under ``root``. Crashing between the two steps only skips a number."""
    own = Folder(spark, f"{checkpoint.rstrip('/')}/_run")
    held = [int(n) for n in own.names() if n.isdigit()]
    if held:
        return max(held)
    ledger = Folder(spark, f"{root.rstrip('/')}/{LEDGER}")
    run = max((int(n) for n in ledger.names() if n.isdigit()), default=-1) + 1
    while not ledger.create(str(run)):
        run += 1
    own.create(str(run))
    return run


def fence(spark: SparkSession, root: str, run: int) -> None:
    """Stop a batch of a run that a newer one has replaced."""
    if Folder(spark, f"{root.rstrip('/')}/{LEDGER}").exists(str(run + 1)):
        raise StaleRun(f"run {run} was replaced by a newer one writing to {root}")
