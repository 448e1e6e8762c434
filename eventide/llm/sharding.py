"""Uniform shuffle into shards of exact sizes through a hypergeometric
communication matrix.

Rows are dealt into source blocks by hash. For the block sizes (row sums) and
the shard sizes (column sums: N/S rounded down or up) a matrix is drawn from
the multivariate hypergeometric law, which is the law of the block-to-shard
counts under a uniform permutation of all rows. Each block permutes its rows
locally, hands out as many to each shard as its matrix row says, and each
shard permutes what it received. Only ids, sizes and checksums are shuffled,
never texts.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty

SHARDS = 24
SEED = 20240229
#: Rows of a source block and of a slot run (on average): what one task sorts at once.
ROWS_PER_BLOCK = 200_000
LEAST_BLOCKS = 64


#: Standard deviations on either side of the mode that a count can lie in: beyond, less than 1e-31 is left.
REACH = 12


def hypergeometric_law(good: int, bad: int, n: int) -> tuple[int, np.ndarray]:
    """Smallest count and the probabilities of it and those above it, for the
    number of good places among ``n`` drawn from ``good + bad``. The ratios of
    neighbouring probabilities are rational, so the law is built from its mode
    outwards to double precision, whatever the size of the numbers."""
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    total = good + bad
    spread = math.sqrt(n * (good / total) * (bad / total) * ((total - n) / max(total - 1, 1))) if total else 0.0
    reach = math.ceil(REACH * spread) + REACH
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    # log of p(k + 1) / p(k)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log((bad - n) + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(logs - logs.max())
    return first, weights / weights.sum()


def hypergeometric(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    first, law = hypergeometric_law(good, bad, n)
    return first + min(int(np.searchsorted(np.cumsum(law), draw.random(), "right")), len(law) - 1)


def communication_matrix(block_sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Counts by block and shard with exact row and column sums, drawn row by
    row without replacement from the shards' remaining places: of a row's
    places, those in one shard are hypergeometric given the shards before."""
    total = sum(block_sizes)
    left = [total // shards + (j < total % shards) for j in range(shards)]
    draw = np.random.Generator(np.random.PCG64(seed))
    out = np.zeros((len(block_sizes), shards), np.int64)
    for i, n in enumerate(block_sizes):
        places = sum(left)
        for j in range(shards):
            places -= left[j]
            got = hypergeometric(draw, left[j], places, n) if n else 0
            out[i, j] = got
            left[j] -= got
            n -= got
    return out


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
               rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """One row per row of ``docs`` with its shard and slot.

    Nulls: a null text has size 8 and checksum 0; a null ``doc_id`` is dealt
    by its text. Repeated rows are rows of their own: they share hashes, so
    which of them gets which place is of no consequence. An empty table gives
    no rows. Only ``doc_id`` and ``text`` are read."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_or_empty()) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
    )
    key = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    total = rows.count()
    blocks = max(LEAST_BLOCKS, -(-total // rows_per_block))
    # independent 64-bit words: one picks the block, one orders within it, one orders within the shard
    word = lambda part: F.xxhash64(F.lit(seed), F.lit(part), *key)
    rows = rows.withColumn("block", F.pmod(word("block"), F.lit(blocks)).cast("int"))
    sizes = {r["block"]: r["n"] for r in rows.groupBy("block").agg(F.count("*").alias("n")).toLocalIterator()}
    order = sorted(sizes)
    matrix = communication_matrix([sizes[b] for b in order], shards, seed)
    ends = np.cumsum(matrix, axis=1)
    plan = spark.createDataFrame([(int(b), e.tolist()) for b, e in zip(order, ends, strict=True)],
                                 "block int, ends array<bigint>")

    local = Window.partitionBy("block").orderBy(word("local"), *key)
    dealt = (
        rows.withColumn("place", F.row_number().over(local) - 1)
        .join(plan, "block")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("place"))).cast("int"))
        .drop("ends", "place", "block")
    )
    # Second permutation: runs of the shard by the hash's leading bits, counted, then ordered within.
    runs = max(1, -(-total // (shards * rows_per_block)))
    dealt = dealt.withColumn("word", word("shard")).withColumn(
        "run", F.floor((F.shiftrightunsigned("word", 11) / F.lit(float(1 << 53))) * runs).cast("int"))
    counts = dealt.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "run").orderBy("word", *key)
    return (
        dealt.withColumn("nth", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "run"])
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                (F.col("offset") + F.col("nth")).cast("long").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
    )


def op4_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))
