"""Benchmark decontamination: a broadcast hash set of the benchmark's word
windows, scanned over every document's word windows; hits are verified word
by word, then spans or documents can be removed.

The benchmark is cut into blocks of a bounded number of windows (one block
for any usual benchmark), so what is broadcast is bounded however large the
benchmark grows; each block is one pass over the documents.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, run_edges, slices, strings, table, tidy, window_hashes, worker_cache, written

WINDOW = 10
#: Most benchmark words in one broadcast block; about 100 bytes each on a worker.
BLOCK_WORDS = 1_000_000

#: A word after lower-casing A-Z, in UTF-8: digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD_AT = WORD


def words_of(text: str) -> list[bytes]:
    """bytes.lower() changes A-Z only."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())


class Windows:
    """The windows of a block of benchmark items, by length in words."""

    def __init__(self, items: list[tuple[str | None, str]], n: int = WINDOW) -> None:
        self.ids: dict[bytes, int] = {}
        spots: dict[int, dict[tuple[int, ...], list[str | None]]] = defaultdict(lambda: defaultdict(list))
        for item, text in items:
            own = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            size = min(n, len(own))
            for k in range(len(own) - size + 1 if size else 0):
                spots[size][tuple(own[k:k + size])].append(item)
        #: length -> (sorted hashes, windows in that order, their items)
        self.by_size = {}
        for size, found in spots.items():
            keys = np.array(list(found), np.int64)
            hashes = np.array([window_hashes(k.astype(U64), size)[0] for k in keys], U64)
            order = np.argsort(hashes, kind="stable")
            names = [list(set(x)) for x in found.values()]
            self.by_size[size] = (hashes[order], keys[order], [names[i] for i in order])

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str | None]]:
        """Hit flag by word, and the items whose windows occur."""
        ids = np.fromiter(map(self.ids.get, words, _ZEROS), np.int64, len(words))
        hit, items = np.zeros(len(words), bool), set()
        for size, (hashes, keys, names) in self.by_size.items():
            if len(ids) < size:
                continue
            # only windows all of whose words the benchmark knows can occur
            known = np.r_[0, np.cumsum(ids > 0)]
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            h = window_hashes(ids.astype(U64), size)[at]
            first, last = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            for p, a, b in zip(at[last > first].tolist(), first[last > first].tolist(), last[last > first].tolist(),
                               strict=True):
                for k in range(a, b):
                    if (keys[k] == ids[p:p + size]).all():  # verified word by word
                        hit[p:p + size] = True
                        items.update(names[k])
        return hit, items


class _Zeros:
    """An endless second argument for dict.get in map()."""

    def __iter__(self):
        while True:
            yield 0


_ZEROS = _Zeros()

#: Names of the columns that scan() adds; no column of the documents has them.
N_WORDS, HITS, ITEMS = "__n_words", "__hits", "__items"
FOUND = f"`{N_WORDS}` long, `{HITS}` array<struct<from:long,to:long>>, `{ITEMS}` array<string>"


def _scan(block, columns: list[str], n: int):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache("decontam")
        if name not in kept:  # built once per worker, and one block at a time
            kept.clear()
            kept[name] = Windows(block.value, n)
        known = kept[name]
        kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                counts, hits, items = [], [], []
                for text in strings(batch, "text"):
                    words = words_of(text)
                    hit, found = known.hits(words)
                    starts, ends = run_edges(hit)
                    counts.append(len(words))
                    hits.append([{"from": a, "to": b} for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
                    items.append([*sorted(found - {None}), *found & {None}])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in columns]
                    + [pa.array(counts, pa.int64()), pa.array(hits, kind), pa.array(items, pa.list_(pa.string()))],
                    [*columns, N_WORDS, HITS, ITEMS])
    return tidy(run, "decontam")


def _blocks(benchmark: DataFrame, most_words: int) -> Iterator[list[tuple[str | None, str]]]:
    """Items in blocks of at most ``most_words`` words (or one item)."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text")).filter(
        "text is not null")
    block, size = [], 0
    for r in rows.toLocalIterator():
        n = len(words_of(r["text"]))
        if block and size + n > most_words:
            yield block
            block, size = [], 0
        block.append((r["item"], r["text"]))
        size += n
    yield block


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with N_WORDS, HITS (word runs inside occurrences of a block's
    windows, per block) and ITEMS (ids whose windows occur).

    Needs columns doc_id and text; passes all columns through. More than one
    block: passes over the written result of the pass before."""
    spark = docs.sparkSession
    out, columns = docs, docs.columns
    for k, block in enumerate(_blocks(benchmark, block_words)):
        shared = spark.sparkContext.broadcast(block)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        if k:
            out = written(out, "decontam").withColumnsRenamed(
                {N_WORDS: "__words", HITS: "__hits_before", ITEMS: "__items_before"})
            schema += (", `__words` long, `__hits_before` array<struct<from:long,to:long>>, "
                       "`__items_before` array<string>")
        out = out.mapInArrow(_scan(shared, out.columns, n), f"{schema}, {FOUND}")
        if k:
            out = out.select(*columns, N_WORDS, F.concat("__hits_before", HITS).alias(HITS),
                             F.array_union("__items_before", ITEMS).alias(ITEMS))
    return out


def _union_length(hits: str) -> F.Column:
    """Words in the union of the runs."""
    state = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort(hits), state,
        lambda s, x: F.struct(
            F.greatest(s["end"], x["to"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["to"] - F.greatest(s["end"], x["from"]))).alias("n")),
        lambda s: s["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row.

    Null or wordless texts have no words and no hits. Benchmark items with a
    null text are skipped; those with a null id count as one item, which
    items_sha256 leaves out, as in SQL; rows repeated in either table are scanned as
    they are. Items of the same id count once. Empty tables give no rows or no
    hits. Only doc_id and text (item_id and text) are read."""
    found = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, n, block_words)
    return found.select(
        "doc_id", F.col(N_WORDS).alias("n_words"), _union_length(HITS).alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(ITEMS)).cast("binary"), 256).alias("items_sha256"),
        (F.size(HITS) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """The rows without any hit, all columns; one map-only pass."""
    return scan(docs, benchmark, n).filter(F.size(HITS) == 0).select(*docs.columns)


def cut_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """All rows, with the hit words (and what stands between them) removed
    from the text."""
    @F.pandas_udf("string")
    def cut(text, hits):
        return text.combine(hits, _cut_one)

    found = scan(docs, benchmark, n)
    return found.withColumn("text", F.when(F.size(HITS) > 0, cut("text", HITS)).otherwise(F.col("text"))).select(
        *docs.columns)


def _cut_one(text: str | None, hits) -> str | None:
    if text is None:  # the function is called for rows without hits too
        return None
    raw = text.encode()
    spots = [(m.start(), m.end()) for m in WORD_AT.finditer(raw.lower())]
    kept, at = [], 0
    for a, b in sorted((h["from"], h["to"]) for h in hits):
        kept.append(raw[at:max(at, spots[a][0])])
        at = max(at, spots[b - 1][1])
    return b"".join([*kept, raw[at:]]).decode()


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id::VARCHAR AS id, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', item_id::VARCHAR, NULL, coalesce(text, '') FROM benchmark),
words AS (
  SELECT kind, id, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
win AS (
  SELECT DISTINCT id AS item, least(10, len(w)) AS size,
         array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p FROM words WHERE kind = 'b' AND len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
spots AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
  FROM words, sizes WHERE kind = 'd' AND len(w) >= size),
occ AS (
  SELECT s.doc_id, s.p, s.size, win.item
  FROM (SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS gram FROM spots) s
  JOIN win ON win.size = s.size AND win.gram = s.gram),
hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM (SELECT DISTINCT doc_id, p, size FROM occ)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
WHERE d.kind = 'd'
"""
