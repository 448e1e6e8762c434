"""Removal of byte strings that also start elsewhere, by a distributed
difference-cover suffix sort of the texts' parse.

Sorting all byte suffixes of the corpus would shuffle several times its size,
so the text is first parsed: in every window of ``length`` bytes the smallest
hash of ``length / 2 + 1`` bytes is an anchor. Equal windows have equal anchors
at equal places, so a window can only repeat if its anchor does, and a text is a
string of anchor names, a hundredth as long. An anchor's bytes reach at least to
the next anchor, so no byte lies between names. Only anchors that repeat go on.

1. Sample the positions of that string whose index is not 0 modulo 3 (the
   difference cover), take the triples that begin there, sort the triples that
   occur more than once, and name them by rank.
2. Recurse: the names at 1 mod 3, then at 2 mod 3, are a string of their own.
   A name stands for the bytes of its three parts; recursion ends when all
   names that repeat span ``length`` bytes. Every place of such a name is a
   repeat; one place keeps the bytes, the others need no further work.
3. Merge the remaining suffixes, which begin at any byte of the parsed
   regions that is not inside such a place: their prefixes of ``length`` bytes,
   as fingerprints of 126 bits, are cut into ranges, merged in order, and adjacent
   ones compared. Equal ones are repeats.

Fingerprints of ``length`` bytes decide equality: a 64-bit hash modulo 2**64 and
one of 62 bits modulo two primes. Among n different prefixes, n**2 / 2**127
pairs are expected to share both. Names are the second hash alone; a name counts
only in a triple, with its neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (U64, mix, prefix_sums, row_key, run_edges, sized, slices, strings, table, text_or_empty,
                     window_hashes, written)

LENGTH = 400
#: Bytes of the texts that form one packet of fingerprints, on average: dealt by
#: hash, so a packet's size is bounded by this and its longest text.
PACKET_BYTES = 1 << 20
LEAST_PACKETS = 16
#: Ranges of the merge in one task.
TASK_RANGES = 16
#: Bytes of candidate text in one range of the merge, on average.
RANGE_BYTES = 4 << 20
LEAST_RANGES = 64
#: Moduli of the second hash, with a base for each. Modulo 2**64 alone, strings
#: after Thue and Morse share a hash whatever the base.
FIELDS = ((2**31 - 1, 0x2545F491), (2**31 - 19, 0x5851F42D))


class FieldPowers:
    """Powers of the bases and of their inverses, grown on demand."""

    def __init__(self) -> None:
        self.known = [[np.ones(1, U64), np.ones(1, U64)] for _ in FIELDS]

    def upto(self, n: int) -> list[list[np.ndarray]]:
        for (prime, base), both in zip(FIELDS, self.known, strict=True):
            for k, b in enumerate((base, pow(base, -1, prime))):
                while len(both[k]) <= n:
                    step = U64(pow(b, len(both[k]), prime))
                    both[k] = np.r_[both[k], both[k] * step % U64(prime)]
        return self.known


FIELD_POWERS = FieldPowers()


def field_sums(data: np.ndarray) -> list[np.ndarray]:
    """Prefix sums of the second hash, one array by modulus."""
    out = []
    for (prime, _), (up, _) in zip(FIELDS, FIELD_POWERS.upto(len(data)), strict=True):
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(data.astype(U64) * up[: len(data)] % U64(prime), out=sums[1:])
        out.append(sums)
    return out


def field_hashes(sums: list[np.ndarray], k: int) -> np.ndarray:
    """Second hash of every run of ``k`` bytes."""
    n = len(sums[0]) - k
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for (prime, _), (_, down), own in zip(FIELDS, FIELD_POWERS.upto(n), sums, strict=True):
        out = (out << U64(31)) | ((own[k:] - own[:n]) % U64(prime) * down[:n] % U64(prime))
    return mix(out)


def slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """Minimum or maximum of every run of ``width`` values, by doubling."""
    size = 1
    while 2 * size <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    return best(values[: len(values) - (width - size)], values[width - size:]) if size < width else values


def anchor_length(length: int) -> int:
    """Bytes of an anchor: no fewer than the places in a window where one can
    begin, hence than the largest step to the next anchor."""
    return length // 2 + 1


def window_minima(sums: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every string of an anchor's length, and of each window its smallest."""
    half = anchor_length(length)
    hashes = field_hashes(sums, half)
    width = length - half + 1
    return hashes, slide(hashes, width, np.minimum) if len(hashes) >= width else np.empty(0, U64)


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes that are the smallest of some window (all of them, on ties)."""
    hashes, low = window_minima(field_sums(data), length)
    if not len(low):
        return np.empty(0, np.int64), np.empty(0, U64)
    pad = np.zeros(length - anchor_length(length), U64)
    at = np.flatnonzero(slide(np.r_[pad, low, pad], len(pad) + 1, np.maximum) == hashes)
    return at, hashes[at]


def _parse(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                at, name = [], []
                for text in strings(batch, "text"):
                    p, h = anchors(np.frombuffer(text.encode(), np.uint8), length)
                    at.append(p.astype(np.int32).tobytes())
                    name.append(h.tobytes())
                keep = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)) for c in keep),
                     pa.array(at, pa.binary()), pa.array(name, pa.binary())], [*keep, "at", "names"])
    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column(1)]
        names = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(2)]
        if not at:
            continue
        n = [len(x) for x in at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), n)),
             pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in n])),
             pa.array(np.concatenate(at)), pa.array(np.concatenate(names))], ["tid", "q", "at", "name"])


def repeated_anchors(texts: DataFrame) -> DataFrame:
    """tid, q (index in the text's parse), at, name of anchors that occur more than once."""
    every = texts.select("tid", "at", "names").mapInArrow(_exploded, "tid long, q int, at int, name long")
    # written, so that both sides of the join are shuffled plainly and a name that
    # a large share of all texts holds can be split
    more = written(every.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name"), "more")
    return written(every.join(more, "name").select("tid", "q", "at", "name"), "anchors")


def repeats(parse: DataFrame, length: int) -> DataFrame:
    """tid, at, span, keeper: places of names that repeat and span ``length``
    bytes; ``keeper`` says that the place keeps the bytes of its name for the
    merge. ``parse`` is the string of names by text (see the module's text)."""
    level = parse.select("tid", F.lit(0).alias("chain"), "q", "at", F.lit(anchor_length(length)).alias("span"), "name")
    found = None
    while True:
        of_text = Window.partitionBy("tid", "chain").orderBy("q")
        ahead = lambda c, k: F.lead(c, k).over(of_text)
        triples = level.select(
            "*", *[ahead(c, k).alias(f"{c}{k}") for k in (1, 2) for c in ("q", "at", "name")],
            ahead("span", 2).alias("span2"),
        ).filter(
            # the sample; of names that do not yet span the length; without a gap in the string
            (F.col("q") % 3 != 0) & (F.col("span") < length) & (F.col("q1") == F.col("q") + 1)
            & (F.col("q2") == F.col("q") + 2)
        ).select("tid", "chain", "q", "at", (F.col("at2") - F.col("at") + F.col("span2")).alias("span"), "name",
                 (F.col("at1") - F.col("at")).alias("step1"), "name1",
                 (F.col("at2") - F.col("at1")).alias("step2"), "name2")
        triple = ["name", "step1", "name1", "step2", "name2"]
        # rank of the sorted triples: the id grows with the order
        ranked = triples.groupBy(*triple).agg(
            F.count("*").alias("n"), F.min(F.struct("tid", "at")).alias("first")).filter("n > 1").orderBy(*triple)
        ranked = written(ranked.withColumn("rank", F.monotonically_increasing_id()), "ranks")
        named = written(triples.join(ranked, triple).select(
            "tid", (F.col("chain") * 3 + F.col("q") % 3).alias("chain"), F.floor(F.col("q") / 3).cast("int").alias("q"),
            "at", "span", F.col("rank").alias("name"),
            F.col("first").eqNullSafe(F.struct("tid", "at")).alias("keeper")), "names")
        full = named.filter(F.col("span") >= length).select("tid", "at", "span", "keeper")
        found = full if found is None else found.unionByName(full)
        level = named.drop("keeper")
        if named.filter(F.col("span") < length).limit(1).count() == 0:
            return found


class Suffixes:
    """The remaining suffixes of one text: where they begin and the
    fingerprints of their prefixes."""

    def __init__(self, text: bytes, names: np.ndarray, spans: list[tuple[int, int, bool]], length: int) -> None:
        data = np.frombuffer(text, np.uint8)
        sums = field_sums(data)
        _, low = window_minima(sums, length)
        open_at = np.isin(low, names)
        self.covered = np.zeros(len(data) + 1, np.int32)
        for at, span, keeper in spans:
            self.covered[at] += 1
            self.covered[at + span] -= 1
            if not keeper:
                open_at[at:at + span - length + 1] = False
        self.starts = np.flatnonzero(open_at)
        self.prints = np.column_stack(
            [window_hashes(data, length, prefix_sums(data))[self.starts], field_hashes(sums, length)[self.starts]])
        self.length, self.text = length, text

    def removed(self, repeat: np.ndarray) -> np.ndarray:
        """Byte mask: spans of the names and prefixes that repeat."""
        cover = self.covered.copy()
        np.add.at(cover, self.starts[repeat], 1)
        np.add.at(cover, self.starts[repeat] + self.length, -1)
        return np.cumsum(cover[:-1]) > 0


def _suffixes(packet: pa.Table, length: int) -> list[Suffixes]:
    out = []
    for text, names, spans in zip(*(packet[c].to_pylist() for c in ("text", "names", "spans")), strict=True):
        out.append(Suffixes((text or "").encode(), np.array(names, np.int64).view(U64),
                            [(s["at"], s["span"], s["keeper"]) for s in spans or []], length))
    return out


def _range_of(prints: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges of equal width over the fingerprints, in their order."""
    return ((prints >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)


def _ranked(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the fingerprints, and which in it equal the one before."""
    order = np.lexsort((prints[:, 1], prints[:, 0]))
    ranked = prints[order]
    return order, np.r_[False, (ranked[1:] == ranked[:-1]).all(1)][:len(prints)]


def _packed(packet: pa.Table, length: int, ranges: int) -> pa.Table:
    """A packet's distinct fingerprints in order, cut at the ranges."""
    own = _suffixes(packet, length)
    prints = np.concatenate([s.prints for s in own])
    order, equal = _ranked(prints)
    prints = prints[order[~equal]]
    cuts = np.searchsorted(_range_of(prints[:, 0], ranges), np.arange(ranges + 1))
    full = np.flatnonzero(np.diff(cuts))
    return pa.table({
        "range": pa.array(full, pa.int64()),
        "packet": pa.array(np.full(len(full), packet["packet"][0].as_py()), pa.int64()),
        "prints": pa.array([prints[cuts[r]:cuts[r + 1]].tobytes() for r in full.tolist()], pa.binary())})


def _compared(runs: pa.Table) -> pa.Table:
    """Merge the packets' sorted runs of a range and compare neighbours: a
    bit for each fingerprint of each packet says that another has it too."""
    parts = [np.frombuffer(x.as_buffer(), U64).reshape(-1, 2) for x in runs["prints"].combine_chunks()]
    every = np.concatenate(parts)
    order, equal = _ranked(every)
    twice = np.zeros(len(every), bool)
    twice[order] = equal | np.r_[equal[1:], False]
    ends = np.cumsum([len(p) for p in parts])
    masks = [np.packbits(twice[e - len(p):e]).tobytes() for e, p in zip(ends.tolist(), parts, strict=True)]
    return pa.table({"range": runs["range"], "packet": runs["packet"], "mask": pa.array(masks, pa.binary())})


RESULT = "tid long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<from:int,to:int>>"


def _resolved(packet: pa.Table, masks: pa.Table, length: int, ranges: int) -> pa.Table:
    """What goes from each text of a packet."""
    own = _suffixes(packet, length) if packet.num_rows else []
    joined = np.concatenate([s.prints for s in own]) if own else np.empty((0, 2), U64)
    order, equal = _ranked(joined)
    nth = np.cumsum(~equal) - 1
    back = np.empty(len(joined), np.int64)
    back[order] = nth
    prints, repeat = joined[order[~equal]], np.bincount(nth) > 1
    cuts = np.searchsorted(_range_of(prints[:, 0], ranges), np.arange(ranges + 1))
    for r, mask in zip(*((masks[c].to_pylist() for c in ("range", "mask")) if masks.num_rows else ((), ())), strict=True):
        n = cuts[r + 1] - cuts[r]
        repeat[cuts[r]:cuts[r + 1]] |= np.unpackbits(np.frombuffer(mask, np.uint8), count=n).astype(bool)
    rows, at = [], 0
    flags = repeat[back]
    for tid, s in zip(packet["tid"].to_pylist() if own else [], own, strict=True):
        gone = s.removed(flags[at:at + len(s.starts)])
        at += len(s.starts)
        starts, ends = run_edges(gone)
        kept = np.frombuffer(s.text, np.uint8)[~gone].tobytes()
        rows.append((tid, int(gone.sum()), len(starts), hashlib.sha256(kept).hexdigest(),
                     [{"from": a, "to": b} for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]))
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
             pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["tid", "n_removed", "n_spans", "kept_sha256", "removed"])


def merge_rest(texts: DataFrame, length: int) -> DataFrame:
    """Step 3 over candidate texts (tid, packet, text, names, spans)."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(LEAST_RANGES, -(-size // RANGE_BYTES))
    runs = texts.groupBy("packet").applyInArrow(
        lambda t: _packed(t, length, ranges), "range long, packet long, prints binary")
    # as many tasks as the text asks for, so that none grows with the table
    masks = runs.repartition(max(LEAST_RANGES, -(-ranges // TASK_RANGES)), "range").groupBy("range").applyInArrow(_compared, "range long, packet long, mask binary")
    return texts.groupBy("packet").cogroup(masks.groupBy("packet")).applyInArrow(
        lambda t, m: _resolved(t, m, length, ranges), RESULT)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte runs)
    for every row of ``docs``: bytes of strings of ``length`` bytes that also
    start elsewhere in the table, the same text included, are removed.

    Equal texts are parsed once; all of them that have ``length`` bytes or
    more go whole. A null text is empty. Rows repeated, or without doc_id, are
    rows of their own. Texts shorter than ``length`` bytes keep everything. An
    empty table gives no rows. Only doc_id and text are read."""
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *row_key(), text_or_empty().alias("text"),
        F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(text_or_empty().cast("binary"), 256)).alias("sha"))
    rows = written(
        read.mapInArrow(_parse(length), "doc_id long, __id long, __text long, n_bytes long, sha binary, "
                                        "at binary, names binary")
        .withColumn("tid", F.monotonically_increasing_id()), "parsed")
    groups = written(rows.groupBy("sha").agg(F.count("*").alias("n"), F.min("tid").alias("tid")), "texts")
    texts = rows.join(groups.select("tid"), "tid", "left_semi")
    parse = repeated_anchors(texts)
    spans = repeats(parse, length).groupBy("tid").agg(F.collect_list(F.struct("at", "span", "keeper")).alias("spans"))
    marks = parse.groupBy("tid").agg(F.collect_set("name").alias("names")).join(spans, "tid", "left")
    marks = written(marks, "marks")
    keys = written(texts.select("tid", "__id", "__text").join(marks.select("tid"), "tid"), "keys")
    candidates = docs.select(*row_key(), text_or_empty().alias("text")).join(
        sized(keys, keys.count()), ["__id", "__text"]).select("tid", "text")
    # a row repeated in the table gives its text several times; one stays
    repeated = rows.groupBy("__id", "__text").count().filter("count > 1").limit(1).count() > 0
    if repeated:
        candidates = candidates.dropDuplicates(["tid"])
    candidates = candidates.join(marks, "tid")
    size = rows.join(marks.select("tid"), "tid", "left_semi").agg(F.sum("n_bytes")).first()[0] or 0
    packets = max(LEAST_PACKETS, -(-size // PACKET_BYTES))
    candidates = written(candidates.select(
        "tid", F.pmod(F.xxhash64("tid"), F.lit(packets)).alias("packet"), "text", "names", "spans"), "candidates")
    found = merge_rest(candidates, length)

    whole = (F.col("n") > 1) & (F.col("n_bytes") >= length)
    nothing = F.expr("cast(array() as array<struct<from:int,to:int>>)")
    return (
        rows.select("doc_id", "n_bytes", "sha").join(groups, "sha").join(found, "tid", "left")
        .select(
            "doc_id", "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(
                F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
            F.when(whole, F.array(F.struct(F.lit(0).alias("from"), F.col("n_bytes").cast("int").alias("to"))))
            .otherwise(F.coalesce("removed", nothing)).alias("removed")))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("removed")
