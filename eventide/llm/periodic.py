"""Runs of repeating words, by descending-LCP Kruskal over ordered position sets.

A run of period q and length l is a pair of places, its start s and s + q, whose
suffixes share l - q words. The suffixes of a document's words are sorted; the
links between neighbours in that order are taken by falling common prefix, as
Kruskal's algorithm takes edges, and unite classes of suffixes. Each class keeps
its places in text order, the smaller set going into the larger. When s and
s + q meet in a class they are neighbours there: a place between them would mean
a smaller period. So two places that become neighbours at a distance within
their common prefix are a run (or, if the words before them agree as well, its
continuation, which is skipped).

A run of ``least`` words or more needs a common prefix of ``least / 2`` words,
so classes below that are never united, and a class whose closest places lie
further apart than its longest common prefix holds no run.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, strings, table, tidy

#: Least words of a run, and least number of its periods.
LEAST, TIMES = 12, 2

#: Rearranges a document: from its id and number of words to the number of the
#: original word at each place (None: as it is).
Edit = Callable[[int, int], "np.ndarray | None"]


def doubled_ranks(first: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Ranks of all strings of 1, 2, 4 ... symbols (at each place the number of
    places whose string is smaller), until no two are equal. Only places whose
    string still has an equal go on. Strings must not run over the end unequal:
    the last symbol occurs once."""
    n = len(first)
    order = np.argsort(first, kind="stable")
    ranks, todo = np.empty(n, np.int64), order
    new, alone = _groups(first[order], np.zeros(n, np.int64))
    ranks[order] = new
    levels, size = [(1, ranks.astype(np.int32))], 1
    todo = order[~alone]
    while len(todo):
        old, behind = ranks[todo], ranks[todo + size]
        by = np.lexsort((behind, old))
        todo, old, behind = todo[by], old[by], behind[by]
        new, alone = _groups(old * n + behind, old)
        ranks[todo] = new
        size *= 2
        levels.append((size, ranks.astype(np.int32)))
        todo = todo[~alone]
    return levels


def _groups(keys: np.ndarray, old: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys, each old rank plus the key's first place among those of
    that rank, and which keys occur once."""
    at = np.arange(len(keys))
    starts = np.r_[True, keys[1:] != keys[:-1]][:len(keys)]
    outer = np.r_[True, old[1:] != old[:-1]][:len(keys)]
    first = np.maximum.accumulate(np.where(starts, at, 0))
    base = np.maximum.accumulate(np.where(outer, at, 0))
    alone = starts & np.r_[starts[1:], True][:len(keys)]
    return old + first - base, alone


def common_prefixes(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` share."""
    out = np.zeros(len(a), np.int64)
    for size, ranks in reversed(levels):
        out += size * (ranks[a + out] == ranks[b + out])
    return out


def candidate_links(levels: list[tuple[int, np.ndarray]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order and the common prefix of each with the next one (0
    where the next is of another class), for the classes that may hold a run."""
    size, ranks = max((x for x in levels if x[0] <= least), key=lambda x: x[0])
    held = np.flatnonzero(np.bincount(ranks, minlength=len(ranks))[ranks] > 1)
    places = held[np.argsort(levels[-1][1][held])]
    if len(places) < 2:
        return places[:0], places[:0]
    shared = np.r_[common_prefixes(levels, places[:-1], places[1:]), 0]
    shared[shared < least] = 0
    group = np.cumsum(np.r_[True, shared[:-1] == 0]) - 1
    order = np.lexsort((places, group))
    sorted_places, sorted_group = places[order], group[order]
    gaps = np.where(np.diff(sorted_group) == 0, np.diff(sorted_places), len(ranks))
    starts = np.flatnonzero(np.r_[True, np.diff(group) > 0])
    longest = np.maximum.reduceat(shared, starts)
    closest = np.minimum.reduceat(np.r_[gaps, len(ranks)], starts)
    keep = (closest <= longest)[group]
    return places[keep], shared[keep]


def united(places: list[int], shared: list[int]) -> Iterator[tuple[int, int, int]]:
    """Unite neighbours in suffix order by falling common prefix; give (place,
    place behind it, common prefix) of all pairs that become neighbours."""
    root, sets = list(range(len(places))), [[p] for p in places]

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    for k in sorted((k for k, n in enumerate(shared) if n), key=lambda k: -shared[k]):
        a, b, length = find(k), find(k + 1), shared[k]
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large, small = sets[a], sets[b]
        gap, last = -1, 0
        for p in small:
            at = bisect_left(large, p)
            if at != gap:  # the first of its set in this gap, and the last in the one before
                if 0 <= gap < len(large):
                    yield last, large[gap], length
                if at:
                    yield large[at - 1], p, length
                gap = at
            last = p
        if gap < len(large):
            yield last, large[gap], length
        if len(small) * 8 < len(large):
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()
        root[b], sets[b] = a, []


def runs(symbols: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, for documents laid end to end, each
    with a symbol before its first and behind its last word that occurs once."""
    levels = doubled_ranks(symbols)
    places, shared = candidate_links(levels, -(-least * (times - 1) // times))
    word = levels[0][1]
    found = []
    for a, b, length in united(places.tolist(), shared.tolist()):
        period = b - a
        if length >= period * (times - 1) and length + period >= least and word[a - 1] != word[b - 1]:
            found.append((a, length + period, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _documents(ids: list, texts: list[str], edit: Edit | None) -> Iterator[tuple]:
    """Result of each text: n_runs, the longest run's four numbers, the two digests."""
    known: dict[bytes, int] = {}
    number = known.setdefault
    words, symbols, begins, at = [], [], [], 1
    for k, (doc, text) in enumerate(zip(ids, texts, strict=True)):
        own = text.encode().split()  # bytes split at ASCII white space only
        moved = edit(doc, len(own)) if edit is not None and doc is not None else None
        if moved is not None:
            own = [own[i] for i in moved.tolist()]
        words.append(own)
        begins.append(at)
        at += len(own) + 1
        # a document's number goes before the word's, so that words of two documents never agree
        symbols.append(np.array([number(w, len(known)) + 1 for w in own] + [0], np.int64) + (k << 32))
    found = runs(np.concatenate([[-1], *symbols]))
    owner = np.searchsorted(begins, [r[0] for r in found], "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for k, own in enumerate(words):
        mine = [(s - begins[k], n, q) for s, n, q in found[cuts[k]:cuts[k + 1]]]
        best = min(mine, key=lambda r: (-r[1], r[0], r[2]), default=None)
        if mine:
            cover = np.zeros(len(own) + 1, np.int64)
            for s, n, q in mine:
                cover[s + q] += 1
                cover[s + n] -= 1
            own = compress(own, np.cumsum(cover[:-1]) == 0)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in mine)
        yield (len(mine), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
               hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(own)).hexdigest(),
               [{"start": s, "length": n, "period": q} for s, n, q in mine])


RUN = "struct<start:long,length:long,period:long>"
RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          f"collapsed_sha256 string, runs array<{RUN}>")


def find_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the longest
    run (ties: smallest start, then period; nulls without a run), digests of the
    list of runs and of the text without repeats, and the runs, for every row of
    ``docs``, in one map-only pass.

    Words are split at ASCII white space. A null or empty text has no words and
    no run. Repeated rows give a row each; a row without doc_id is never
    edited. An empty table gives no rows. Only doc_id and text are read, so
    further columns of any name do no harm. A task holds about 1 MB of text, or
    one text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(run_type)]
        names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs"]
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                rows = zip(*_documents(batch.column(0).to_pylist(), strings(batch, "text"), edit), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, t) for c, t in zip(rows, kinds, strict=True))], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), RESULT)


def periodic_tail(doc_id: int, n: int) -> np.ndarray | None:
    """The query's edit: one document in ten repeats the words from a place on."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_runs(table(spark, sf_dir, "documents"), periodic_tail).drop("runs")
