"""Exact deduplication against a minimal perfect hash over the distinct
digests of an already ingested history.

The history is reduced to one record per distinct digest (map-side combined).
Its digests are dealt into small bins; every bin gets a minimal perfect hash
(hash and displace), whose slots hold the full digest and the locator of the
row that stays. New rows, pre-aggregated by digest, look their slot up and
compare all 32 digest bytes: members are repeats of history, nonmembers form
groups among themselves. Bins of history and lookups meet in one shuffle on
the bin, at any size; nothing is collected or broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, row_key, table, text_or_empty, without, written

#: Distinct digests a bin holds on average, and keys a displacement serves.
BIN_KEYS = 4096
KEYS_PER_SEED = 4
DIGEST_BYTES = 32

BLANK = r"[\x20\x09-\x0D]"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, row key, code points of the original text and the digest of the
    text without blanks (null text: empty)."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *row_key(),
        F.length(text).cast("long").alias("n_points"),
        F.unhex(F.sha2(F.regexp_replace(text, BLANK, "").cast("binary"), 256)).alias("digest"),
    )


def best_first() -> F.Column:
    """Sort key whose minimum is the row that stays: most code points, then
    the smallest doc_id (null last); the text's hash settles what is left."""
    return F.struct((-F.col("n_points")).alias("short"), F.col("doc_id").isNull().alias("no_id"),
                    F.col("doc_id").alias("doc_id"), F.col("__text").alias("text"))


def by_digest(rows: DataFrame) -> DataFrame:
    """One record per digest: rows and winner, combined before the shuffle."""
    return rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(best_first()).alias("best"))


class PerfectHash:
    """Minimal perfect hash of one bin: first-level buckets of a few keys are
    placed largest first; a bucket's seed is the first that sends its keys to
    free slots of [0, number of keys)."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.n, self.m = n, max(1, -(-n // KEYS_PER_SEED))
        self.seeds = np.zeros(self.m, np.int64)
        taken = np.zeros(n, bool)
        bucket = self._bucket(words)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.m + 1))
        for b in np.argsort(-np.diff(starts), kind="stable"):
            keys = words[order[starts[b]:starts[b + 1]]]
            if not len(keys):
                break
            seed = 0
            while True:
                at = self._place(keys, np.full(len(keys), seed, np.int64))
                if not taken[at].any() and len(np.unique(at)) == len(at):
                    break
                seed += 1
            self.seeds[b] = seed
            taken[at] = True

    def _bucket(self, words: np.ndarray) -> np.ndarray:
        return (mix(words) % np.uint64(self.m)).astype(np.int64)

    def _place(self, words: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        salt = mix((seeds + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        return (mix(words ^ salt) % np.uint64(self.n)).astype(np.int64)

    def slots(self, words: np.ndarray) -> np.ndarray:
        """Slot of any key; a key outside the built set gets an arbitrary one."""
        if not self.n:
            return np.zeros(len(words), np.int64)
        return self._place(words, self.seeds[self._bucket(words)])


def _words(digest: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The digests as bytes, and the word that the hash works on."""
    raw = np.frombuffer(b"".join(digest.to_pylist()), np.uint8).reshape(-1, DIGEST_BYTES)
    return raw, np.ascontiguousarray(raw[:, 8:16]).view("<u8").ravel().astype(np.uint64)


BEST = "struct<short:long,no_id:boolean,doc_id:long,text:long>"
LOOKED_UP = f"digest binary, n long, best {BEST}, member boolean, slot_n long, slot_best {BEST}"


_BEST = pa.struct([("short", pa.int64()), ("no_id", pa.bool_()), ("doc_id", pa.int64()), ("text", pa.int64())])
_SIDE = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("best", _BEST)])
_FOUND = pa.schema([*_SIDE, ("member", pa.bool_()), ("slot_n", pa.int64()), ("slot_best", _BEST)])


def _side(rows: pa.Table) -> pa.Table:
    return rows.select(_SIDE.names).cast(_SIDE) if rows.num_rows else _SIDE.empty_table()


def _one_bin(history: pa.Table, new: pa.Table) -> pa.Table:
    """Build the bin's hash, fill the slots, look the new digests up."""
    history, new = _side(history), _side(new)
    raw, words = _words(history["digest"])
    # distinct digests may share their 8-byte word; such keys (if any) live in an overflow list
    lone = np.zeros(len(words), bool)
    lone[np.unique(words, return_index=True)[1]] = True
    held = PerfectHash(words[lone])
    locator = np.full(held.n, -1, np.int64)
    locator[held.slots(words[lone])] = np.flatnonzero(lone)
    overflow = {raw[i].tobytes(): i for i in np.flatnonzero(~lone).tolist()}

    asked, asked_words = _words(new["digest"])
    row = locator[held.slots(asked_words)] if held.n else np.full(len(asked), -1, np.int64)
    if held.n:
        row[(raw[row] != asked).any(axis=1)] = -1  # all bytes decide, not the hash
    if overflow:
        for i in np.flatnonzero(row < 0).tolist():
            row[i] = overflow.get(asked[i].tobytes(), -1)
    alone = np.ones(len(words), bool)  # history without a new copy
    alone[row[row >= 0]] = False
    rest = np.flatnonzero(alone)

    at = pa.array(np.r_[row, rest], mask=np.r_[row < 0, np.zeros(len(rest), bool)])
    came = pa.array(np.r_[np.arange(len(row)), np.zeros(len(rest), np.int64)],
                    mask=np.r_[np.zeros(len(row), bool), np.ones(len(rest), bool)])
    return pa.table({
        "digest": pa.chunked_array([*new["digest"].chunks, *history["digest"].take(pa.array(rest)).chunks], pa.binary()),
        "n": new["n"].take(came), "best": new["best"].take(came),
        "member": pa.array(np.r_[row >= 0, np.ones(len(rest), bool)]),
        "slot_n": history["n"].take(at), "slot_best": history["best"].take(at),
    }, schema=_FOUND)


def lookup(history: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct digests of both sides: ``member`` says that history holds the
    digest. Both sides have one row per digest (``by_digest``)."""
    bins = max(1, -(-history.count() // BIN_KEYS))
    word = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long")
    # fresh attributes: a cogroup of two plans that share some loses the right side's
    binned = lambda df: df.select(F.pmod(word, F.lit(bins)).alias("bin"), *[F.col(c).alias(c) for c in _SIDE.names])
    return binned(history).groupBy("bin").cogroup(binned(new).groupBy("bin")).applyInArrow(
        _one_bin, LOOKED_UP)


def groups(history: DataFrame, new: DataFrame) -> DataFrame:
    """One row per distinct digest of history and new rows together: keep_id,
    group_size, and whether history already held it."""
    found = lookup(by_digest(history), by_digest(new))
    return found.select(
        "digest", "member",
        (F.coalesce("n", F.lit(0)) + F.coalesce("slot_n", F.lit(0))).alias("group_size"),
        F.least("best", "slot_best").alias("best"))  # least() skips nulls


def exact_dedup(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` and ``history``: doc_id, keep_id,
    group_size, kept, text_sha256, in_history.

    Without ``history``, the rows with an even digest of their doc_id count as
    ingested earlier and the others as new; the winner of a group is the best
    row of both. Null text: empty. Null doc_id: a row like others, kept only
    in a group without ids. Rows repeated with the same doc_id are equal
    rows: each of them that is the winner says kept. An empty table gives no
    rows. Only doc_id and text are read; other columns may have any name."""
    if history is None:
        rows = written(digests(docs).withColumn(
            "old", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), "digests")
    else:
        rows = written(digests(docs).withColumn("old", F.lit(False)).unionByName(
            digests(history).withColumn("old", F.lit(True))), "digests")
    found = groups(rows.filter("old"), rows.filter("not old"))
    out = rows.join(found, "digest")
    return out.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("__text") == F.col("best.text"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), F.col("member").alias("in_history"), "__id", "__text")


COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(COLUMNS)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Rows repeated with the
    same doc_id and text count once."""
    found = written(exact_dedup(docs), "exact")
    repeated = found.filter("kept").groupBy("text_sha256").count().filter("count > 1").limit(1).count() > 0
    return without(docs, found.filter("not kept").select("__id", "__text"), repeated)


SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
