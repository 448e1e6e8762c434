"""Removal of word windows that also start in an earlier document, by
super-k-mer partitioning.

Every run of eight words has a hash; the smallest in a window is its minimiser.
Windows that lie side by side mostly share it, and travel as one packed string,
a super-k-mer, to the bucket of that minimiser. Equal windows have equal
minimisers, so they meet in one bucket; there all windows are sorted by their
words (not by hashes) and counted.

* Minimisers that occur in one text only hold no repeat; their strings never
  travel. Equal texts travel once.
* A minimiser whose strings have more than ``hot_bytes`` in all (a passage that
  many texts hold in different surroundings) would fill its bucket. Its windows
  travel one by one instead, as 128-bit cryptographic digests, which Spark
  reduces before the shuffle; so no bucket grows with the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (row_key, run_edges, sized, slices, strings, table, text_or_empty, window_hashes, word_arrays,
                     written)
from .suffix import slide

WINDOW = 50
#: Words of a minimiser.
GRAM = 8
#: Windows in one packed string at most (more that share a minimiser go in pieces).
PIECE = 512
#: Bytes of the strings of one minimiser that may go to one bucket, and of a bucket on average.
HOT_BYTES, BUCKET_BYTES = 1 << 20, 4 << 20
LEAST_BUCKETS = 64

#: Words are parted by ASCII white space only, and taken unchanged.
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
SAME = np.arange(256, dtype=np.uint8)

#: Orders rows without doc_id behind all others.
LAST_ID = (1 << 63) - 1


def super_kmers(texts: list[str], window: int) -> tuple[np.ndarray, ...]:
    """Owner (number of the text), first window, windows and minimiser of every super-k-mer."""
    gram = min(GRAM, window)
    words, doc = word_arrays(texts, IS_WORD, SAME)
    begins = np.searchsorted(doc, np.arange(len(texts)))
    grams = window_hashes(words, gram)
    if len(words) < window:
        return (np.empty(0, np.int64),) * 4
    low = slide(grams, window - gram + 1, np.minimum)
    inside = doc[: len(low)] == doc[window - 1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return (np.empty(0, np.int64),) * 4
    new = np.r_[True, (low[at[1:]] != low[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])]
    nth = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    first = np.flatnonzero(nth % PIECE == 0)
    owner = doc[at[first]]
    return owner, at[first] - begins[owner], np.diff(np.r_[first, len(at)]), low[at[first]].view(np.int64)


def _parse(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                texts = strings(batch, "text")
                split = [t.encode().split() for t in texts]
                owner, at, n, names = super_kmers(texts, window)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
                listed, sizes = [], []
                for k, own in enumerate(split):
                    part = slice(cuts[k], cuts[k + 1])
                    ends = np.cumsum([0, *(len(w) + 1 for w in own)])
                    spans = ends[at[part] + n[part] + window - 1] - ends[at[part]]
                    name, nth = np.unique(names[part], return_inverse=True)
                    listed.append(name.tolist())
                    sizes.append(np.bincount(nth, spans, len(name)).astype(np.int64).tolist())
                keep = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)) for c in keep),
                     pa.array([len(w) for w in split], pa.int64()),
                     pa.array([hashlib.sha256(b" ".join(w)).digest() for w in split], pa.binary()),
                     pa.array(listed, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int64()))],
                    [*keep, "n_words", "sha", "names", "sizes"])
    return run


def _packed(window: int):
    """The packed strings of the candidates' cold minimisers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                tids, befores, cold = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                                       for c in ("tid", "before", "cold"))
                texts = strings(batch, "text")
                owner, at, n, names = super_kmers(texts, window)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
                rows = []
                for k, text in enumerate(texts):
                    if not cold[k]:
                        continue
                    words, part = text.encode().split(), slice(cuts[k], cuts[k + 1])
                    wanted = np.isin(names[part], cold[k])
                    for p, m, name in zip(at[part][wanted].tolist(), n[part][wanted].tolist(),
                                          names[part][wanted].tolist(), strict=True):
                        rows.append((tids[k], befores[k], p, name, b" ".join(words[p:p + m + window - 1])))
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                                 ["tid", "before", "at", "name", "packed"])
    return run


def _hot_windows(window: int):
    """Digests of the windows of the candidates' hot minimisers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                tids, befores, hot = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                                      for c in ("tid", "before", "hot"))
                texts = strings(batch, "text")
                owner, at, n, names = super_kmers(texts, window)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
                for k, text in enumerate(texts):
                    words, part = text.encode().split(), slice(cuts[k], cuts[k + 1])
                    wanted = np.isin(names[part], hot[k])
                    ends = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
                    flat = b" ".join(words)
                    starts = [p + j for p, m in zip(at[part][wanted].tolist(), n[part][wanted].tolist(), strict=True)
                              for j in range(m)]
                    for begin in range(0, len(starts), 10_000):
                        own = starts[begin:begin + 10_000]
                        prints = [hashlib.blake2b(flat[ends[p]:ends[p + window] - 1], digest_size=16).digest() for p in own]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tids[k]] * len(own), pa.int64()), pa.array([befores[k]] * len(own), pa.int64()),
                             pa.array(own, pa.int64()), pa.array(prints, pa.binary())], ["tid", "before", "at", "print"])
    return run


def sorted_windows(ids: np.ndarray, window: int) -> np.ndarray:
    """Rank of the ``window`` symbols that begin at each place, by doubling."""
    ranks, size = ids, 1
    while size < window:
        step = min(size, window - size)  # the last step overlaps
        ahead = ranks[step:]
        _, ranks = np.unique(ranks[: len(ahead)] * np.int64(len(ids) + 1) + ahead, return_inverse=True)
        size += step
    return ranks


def _counted(bucket: pa.Table, window: int) -> pa.Table:
    """Word runs (tid, from, to) of a bucket's windows that an earlier document has too."""
    known: dict[bytes, int] = {}
    number = known.setdefault
    ids, sizes = [], []
    for text in bucket["packed"].to_pylist():
        words = text.split()
        sizes.append(len(words))
        ids += [number(w, len(known)) for w in words]
    before = np.repeat(bucket["before"].to_numpy(), sizes)
    ranks = sorted_windows(np.array(ids, np.int64), window)
    nth = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = np.flatnonzero(nth + window <= np.repeat(sizes, sizes))  # windows that lie in one string
    least = np.full(len(ids), LAST_ID)
    np.minimum.at(least, ranks[whole], before[whole])
    later = np.zeros(len(ids), bool)
    later[whole] = least[ranks[whole]] < before[whole]
    starts, ends = run_edges(later)  # the last places of a string begin no window, so runs stay in one string
    place = np.repeat(bucket["at"].to_numpy(), sizes) + nth
    tids = np.repeat(bucket["tid"].to_numpy(), sizes)
    if window == 1:  # nothing parts the strings' runs then
        starts = np.flatnonzero(later)
        ends = starts + 1
    return pa.table({"tid": pa.array(tids[starts], pa.int64()), "from": pa.array(place[starts], pa.int64()),
                     "to": pa.array(place[ends - 1] + window, pa.int64())})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of the candidates without the covered words."""
    for whole in batches:
        for batch in slices(whole, "text", 1 << 20):
            rows = []
            for tid, text, covers in zip(batch.column(0).to_pylist(), strings(batch, "text"), batch.column(2), strict=True):
                words = text.encode().split()
                cover = np.zeros(len(words) + 1, np.int64)
                runs = covers.values
                np.add.at(cover, runs.field("from").to_numpy(), 1)
                np.add.at(cover, runs.field("to").to_numpy(), -1)
                gone = np.cumsum(cover[:-1]) > 0
                starts, ends = run_edges(gone)
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                rows.append((tid, int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                             [{"from": a, "to": b} for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["tid", "n_removed", "kept_sha256", "removed"])


def remove_windows(docs: DataFrame, window: int = WINDOW, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (the words kept, joined by one
    space), removed (runs of word numbers) for every row of ``docs``: words
    covered by a window of ``window`` words that also starts in a row with a
    smaller doc_id are removed.

    A null text has no words; a text shorter than the window keeps everything.
    Rows of the same doc_id never remove words from each other, so repeated rows
    have equal results. A row without doc_id counts as behind all that have one,
    and removes nothing from others. An empty table gives no rows. Only doc_id
    and text are read, so further columns of any name do no harm."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), text_or_empty().alias("text"))
    rows = written(
        read.mapInArrow(_parse(window), "doc_id long, __id long, __text long, n_words long, sha binary, "
                                        "names array<long>, sizes array<long>")
        .withColumn("tid", F.monotonically_increasing_id())
        .withColumn("before", F.coalesce("doc_id", F.lit(LAST_ID))), "parsed")
    # one row of each word sequence, in the place of its first document
    firsts = written(rows.groupBy("sha").agg(F.min("tid").alias("tid"), F.min("before").alias("before")), "firsts")
    texts = rows.drop("before").join(firsts.select("tid", "before"), "tid")
    every = texts.select("tid", "before", F.explode(F.arrays_zip("names", "sizes")).alias("x")).select(
        "tid", "before", F.col("x.names").alias("name"), F.col("x.sizes").alias("size"))
    shared = written(
        every.groupBy("name").agg(F.min("before").alias("a"), F.max("before").alias("b"), F.sum("size").alias("bytes"))
        .filter("a < b").select("name", "bytes", (F.col("bytes") > hot_bytes).alias("hot")), "shared")
    marks = written(
        every.join(shared.select("name", "hot"), "name").groupBy("tid").agg(
            F.min("before").alias("before"), F.collect_list(F.when(~F.col("hot"), F.col("name"))).alias("cold"),
            F.collect_list(F.when(F.col("hot"), F.col("name"))).alias("hot")), "marks")
    keys = written(rows.select("tid", "__id", "__text").join(marks.select("tid"), "tid"), "keys")
    # a row repeated in the table gives its text several times; one stays
    repeated = rows.groupBy("__id", "__text").count().filter("count > 1").limit(1).count() > 0
    found = docs.select(*row_key(), text_or_empty().alias("text")).join(
        sized(keys, keys.count()), ["__id", "__text"]).select("tid", "text")
    if repeated:
        found = found.dropDuplicates(["tid"])
    candidates = written(found.join(marks, "tid"), "candidates")

    cold_bytes = shared.filter("not hot").agg(F.sum("bytes")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-cold_bytes // BUCKET_BYTES))
    packed = candidates.select("tid", "before", "text", "cold").filter(F.size("cold") > 0).mapInArrow(
        _packed(window), "tid long, before long, at long, name long, packed binary")
    covered = packed.groupBy(F.pmod(F.xxhash64("name"), F.lit(buckets)).alias("bucket")).applyInArrow(
        lambda t: _counted(t, window), "tid long, from long, to long")
    hot = written(candidates.select("tid", "before", "text", "hot").filter(F.size("hot") > 0).mapInArrow(
        _hot_windows(window), "tid long, before long, at long, print binary"), "hot")
    low = written(hot.groupBy("print").agg(F.min("before").alias("low"), F.max("before").alias("high")).filter(
        "low < high").select("print", "low"), "low")
    hot_covered = hot.join(low, "print").filter("low < before").select(
        "tid", F.col("at").alias("from"), (F.col("at") + window).alias("to"))
    covers = covered.unionByName(hot_covered).groupBy("tid").agg(F.collect_list(F.struct("from", "to")).alias("covers"))
    cut = candidates.select("tid", "text").join(covers, "tid").mapInArrow(
        _cut, "tid long, n_removed long, kept_sha256 string, removed array<struct<from:long,to:long>>")

    results = firsts.select("sha", "tid", F.col("before").alias("first")).join(cut, "tid", "left").drop("tid")
    copy = (F.col("before") > F.col("first")) & (F.col("n_words") >= window)
    nothing = F.expr("cast(array() as array<struct<from:long,to:long>>)")
    return rows.select("doc_id", "before", "n_words", "sha").join(results, "sha").select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(
            F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
        F.when(copy, F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("n_words").alias("to")))).otherwise(
            F.coalesce("removed", nothing)).alias("removed"))


def op11_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_windows(table(spark, sf_dir, "documents")).drop("removed")


SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), places AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), windows AS (
  SELECT doc_id, place, array_to_string(words[place:place + 49], ' ') AS words
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS place FROM texts WHERE len(words) >= 50)
), lows AS (
  SELECT words, min(doc_id) AS low FROM windows GROUP BY words HAVING min(doc_id) < max(doc_id)
), starts AS (
  SELECT w.doc_id, w.place, 1 AS hit FROM windows w JOIN lows USING (words) WHERE low < w.doc_id
), marked AS (
  SELECT p.doc_id, p.word, p.place, max(coalesce(s.hit, 0)) OVER (
    PARTITION BY p.doc_id ORDER BY p.place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM places p LEFT JOIN starts s USING (doc_id, place)
), kept AS (
  SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone = 0) AS kept
  FROM marked GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""
