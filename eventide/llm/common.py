"""Helpers of the training-data operators: table access, scratch tables in the
shared folder, and array functions used inside Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

U64 = np.uint64
#: Odd multiplier of the polynomial window hashes (any odd 64-bit number with well mixed bits).
BASE = 0x9E3779B97F4A7C15


#: Where this library was loaded from; Python workers import it from the same place.
LIBRARY = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers that start from now on find the library (on a
    cluster: if it is installed at the same path, as with a shared image)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if LIBRARY not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, LIBRARY])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch space and read it
    back: cuts the lineage so that a lost executor re-reads files instead of
    recomputing, and fixes every value that later steps must agree on."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


_CACHES: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What the tasks of one operator keep between them on a Python worker.
    Workers go on to other stages, so what other operators kept is dropped."""
    for name in [name for name in _CACHES if name != owner]:
        del _CACHES[name]
    return _CACHES.setdefault(owner, {})


def give_back() -> None:
    """Return freed memory to the system: the allocators of Python and Arrow
    would keep it for the worker's life, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches], owner: str = "") -> Callable[[Batches], Batches]:
    """``run`` for mapInArrow, as a task that leaves its worker as it found it
    but for the owner's cache."""
    @functools.wraps(run)
    def tidied(batches: Batches) -> Batches:
        worker_cache(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def text_or_empty(name: str = "text") -> F.Column:
    return F.coalesce(F.col(name), F.lit(""))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit words (Steele et al.'s splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


#: Powers kept for ever; longer runs of them are made for each call, so a worker keeps 1 MB whatever it has met.
KEPT_POWERS = 1 << 16


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the power of 0 .. n mod 2**64, as the product of two short runs."""
    low = np.cumprod(np.r_[U64(1), np.full(4095, base, U64)], dtype=U64)
    high = np.cumprod(np.r_[U64(1), np.full(n >> 12, pow(base, 4096, 1 << 64), U64)], dtype=U64)
    return np.multiply.outer(high, low).reshape(-1)[: n + 1]


class Powers:
    """Powers of ``BASE`` and of its inverse mod 2**64."""

    def __init__(self) -> None:
        self.up, self.down = self._both(KEPT_POWERS)

    @staticmethod
    def _both(n: int) -> tuple[np.ndarray, np.ndarray]:
        return powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return (self.up, self.down) if n <= KEPT_POWERS else self._both(n)


POWERS = Powers()


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of ``values[i] * BASE**i`` before each position (mod 2**64)."""
    up, _ = POWERS.upto(len(values))
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values.astype(U64) * up[: len(values)], out=out[1:])
    return out


def window_hashes(values: np.ndarray, k: int, sums: np.ndarray | None = None) -> np.ndarray:
    """Hash of every run of ``k`` values; equal runs have equal hashes."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    sums = prefix_sums(values) if sums is None else sums
    _, down = POWERS.upto(n)
    return mix((sums[k:] - sums[:n]) * down[:n])


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20,
           most_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``most_bytes`` of the string
    column (one row at least) and ``most_rows``, which bounds the Python objects
    alive at once."""
    array = batch.column(batch.schema.get_field_index(column))
    if not len(array):
        return
    sizes = np.cumsum(np.frombuffer(_lengths(array), np.int64))
    begin = 0
    while begin < len(sizes):
        base = sizes[begin - 1] if begin else 0
        end = max(begin + 1, min(begin + most_rows, int(np.searchsorted(sizes, base + most_bytes, "right"))))
        yield batch.slice(begin, end - begin)
        begin = end


def _lengths(array: pa.Array) -> bytes:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(array), 0).cast(pa.int64()).to_numpy(zero_copy_only=False).tobytes()


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's values, null as the empty text."""
    array = batch.column(batch.schema.get_field_index(column))
    return [x or "" for x in array.to_pylist()]


def run_edges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of True."""
    steps = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return steps[::2], steps[1::2]


#: Most rows of a key table that is broadcast (two longs a row, so under 64 MB as a hash table).
BROADCAST_ROWS = 500_000

#: Stands for a null doc_id in keys; a row with this id and the same text is the same row for them.
NO_ID = -(1 << 63)


def row_key(text: str = "text") -> list[F.Column]:
    """Two longs that identify a row by its id and text, the same in every
    scan of the table; rows repeated share them."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("__id"),
            F.xxhash64(text_or_empty(text)).alias("__text")]


def sized(keys: DataFrame, rows: int) -> DataFrame:
    """Broadcast a key table only up to the row bound; a larger one is
    shuffled (Spark then prunes the other side by a runtime Bloom filter)."""
    return F.broadcast(keys) if rows <= BROADCAST_ROWS else keys


def without(docs: DataFrame, removed: DataFrame, repeated: bool) -> DataFrame:
    """``docs`` without the rows whose key is in ``removed`` (__id, __text);
    ``repeated`` says that some rows share a key: one of each then stays."""
    removed = written(removed.distinct(), "removed")
    keyed = docs.select(F.struct("*").alias("row"), *row_key())  # the row's own columns may have any names
    out = keyed.join(sized(removed, removed.count()), ["__id", "__text"], "left_anti")
    if repeated:
        out = out.dropDuplicates(["__id", "__text"])
    return out.select("row.*")


def word_arrays(texts: list[str], is_word: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts (runs of bytes in ``is_word``, after
    mapping bytes by ``fold``) and the number of its text."""
    raw = [t.encode() + b"\n" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    steps = np.diff(np.r_[False, is_word[data]].astype(np.int8))
    starts, stops = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    sums = prefix_sums(fold[data])
    _, down = POWERS.upto(len(data))
    hashes = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(U64))
    return hashes, np.searchsorted(np.cumsum([len(r) for r in raw]), starts, "right")
