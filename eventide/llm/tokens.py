"""Token counts by rank-synchronous merging of ragged arrays.

A batch's distinct pre-tokens lie end to end in one numpy array of symbols.
Each round finds every sequence's lowest-rank pair and merges all its places
in all sequences at once; sequences without a known pair leave. What is left
is counted, so no token list is ever built. A bounded memo on each worker
keeps the counts of pre-tokens already seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_tables import Vocabulary, default_path, vocabulary
from .common import slices, strings, table, tidy, worker_cache

LIMIT = 512
#: Pre-tokens remembered by a worker before the memo starts anew.
MEMO = 400_000
NO_PAIR = np.int64(1 << 40)


class Counter:
    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        keys = np.array([a << 32 | b for a, b, _ in vocab.merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([ab for _, _, ab in vocab.merges], np.int64)
        self.byte_ids = np.array(vocab.byte_ids, np.int64)
        self.memo: dict[str, int] = {}

    def ranks_of(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each symbol; none at a sequence's end."""
        out = np.full(len(symbols), NO_PAIR)
        if len(symbols) > 1:
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[:-1] = np.where(self.keys[at] == key, self.ranks[at], NO_PAIR)
        out[np.cumsum(sizes) - 1] = NO_PAIR
        return out

    def merged(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each word (words are not empty)."""
        left = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        own = np.arange(len(words))
        while len(own):
            starts = np.cumsum(sizes) - sizes
            ranks = self.ranks_of(symbols, sizes)
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NO_PAIR
            left[own[done]] = sizes[done]
            if done.all():
                break
            here = (ranks == np.repeat(lowest, sizes)) & (ranks < NO_PAIR)
            here = _alternate(here)
            symbols = symbols.copy()
            symbols[here] = self.made[ranks[here]]
            keep = ~np.r_[False, here[:-1]] & np.repeat(~done, sizes)
            lost = np.add.reduceat(here.astype(np.int64), starts)
            sizes, own = (sizes - lost)[~done], own[~done]
            symbols = symbols[keep]
        return left

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        memo, found, extra = self.memo, [], []
        for text in texts:
            words, special = [], 0
            for token, piece in self.vocab.pieces(text):
                if token is None:
                    words += self.vocab.pattern.findall(piece)
                else:
                    special += 1
            found.append(words)
            extra.append(special)
        if len(memo) > MEMO:
            memo.clear()
        new = list({w for words in found for w in words if w not in memo})
        if new:
            memo.update(zip(new, self.merged([w.encode() for w in new]).tolist(), strict=True))
        return [sum(map(memo.__getitem__, words)) + n for words, n in zip(found, extra, strict=True)]


def _alternate(mask: np.ndarray) -> np.ndarray:
    """Of touching places (a run of equal symbols) every second one from the
    left: merges do not overlap."""
    at = np.flatnonzero(mask)
    if len(at) > 1:
        first = np.r_[True, np.diff(at) > 1]
        run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        out = np.zeros(len(mask), bool)
        out[at[(np.arange(len(at)) - run) % 2 == 0]] = True
        return out
    return mask


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row, in one map-only
    pass. A null or empty text has 0 tokens. Special strings inside a text
    count as the one special token. Repeated rows are counted each; an empty
    table gives no rows; only doc_id and text are read."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = strings(batch, "text")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                     pa.array(counter.counts(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tidy(run, "tokens"), "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)


def _counter(path: str) -> Counter:
    kept = worker_cache("tokens")
    if path not in kept:
        kept[path] = Counter(vocabulary(path))
    return kept[path]


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
