"""Near-duplicates by DartMinHash signatures (Christiani, 2020).

A document is a weighted set: its five-word shingles, weighted by how often
each occurs. Shingle x of weight w owns the region [0, w) x [0, infinity) of a
plane of (weight, rank). Darts are hashed into unit cells of the plane, the
same for every document, Poisson with mean one a cell; only darts that land in
a document's region below a rank bound are thrown, about k ln k + 2k of them
however large the document is. Each dart falls on one of k coordinates, which
keeps its earliest rank. Two documents agree on a coordinate with the
probability of their weighted Jaccard similarity. Bands of coordinates are
joined, candidates are verified on the shingles themselves, and verified
links are closed to classes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (U64, mix, prefix_sums, row_key, sized, slices, strings, table, tidy, window_hashes, without,
                     word_arrays, written)

SHINGLE = 5
THRESHOLD = 0.8
#: A pair at the threshold shares a band with probability 1 - (1 - 0.8^6)^36, all but 2 in 100,000.
BANDS, ROWS = 36, 6
K = BANDS * ROWS

IS_WORD = np.ones(256, bool)
IS_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32
IS_WORD[ord("A"):ord("Z") + 1] = True

#: Upper ends of a uniform 64-bit word for 0, 1, 2 ... darts in a cell (Poisson, mean 1).
DARTS = np.array([min(int(sum(math.exp(-1) / math.factorial(i) for i in range(n + 1)) * 2.0**64), 2**64 - 1)
                  for n in range(20)], U64)
CELL, DART, PLACE = U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB)


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Elements (a hash of the shingle and of which occurrence it is, so a
    weight is a number of unit elements) and the text each belongs to, sorted;
    words by text; a 128-bit hash of each text's word sequence. A text of
    fewer words is one shingle; one without words has none."""
    n = len(texts)
    words, doc = word_arrays(texts, IS_WORD, FOLD)
    counts = np.bincount(doc, minlength=n)
    ends = np.cumsum(counts)
    starts = ends - counts
    twice = [prefix_sums(w) for w in (words, mix(words ^ CELL))]
    from .common import POWERS

    _, down = POWERS.upto(len(words))
    whole = np.stack([mix((s[ends] - s[starts]) * down[starts] + counts.astype(U64)) for s in twice], axis=1)
    grams = window_hashes(words, size, twice[0])
    inside = doc[: len(grams)] == doc[size - 1: size - 1 + len(grams)]
    short = np.flatnonzero((counts > 0) & (counts < size))
    h = np.r_[grams[inside], whole[short, 0]]
    d = np.r_[doc[: len(grams)][inside], short]
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    if len(h):
        first = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]
        nth = np.arange(len(h)) - np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
        h = mix(h + nth.astype(U64) * DART)
    return h, d, counts, whole


def signatures(elements: np.ndarray, owner: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """Earliest rank of each coordinate for each of ``n`` weighted sets (empty
    sets: infinity). Only integer hashes, additions and comparisons decide, so
    equal darts give equal ranks everywhere."""
    out = np.full((n, k), np.inf)
    weight = np.bincount(owner, minlength=n)
    todo, darts = weight > 0, k * math.log(k) + 2 * k
    while todo.any():
        bound = np.where(todo, darts / np.maximum(weight, 1), 0.0)
        mine = np.flatnonzero(todo[owner])
        cells = np.ceil(bound[owner[mine]]).astype(np.int64)
        of = np.repeat(mine, cells)
        level = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
        word = mix(elements[of] + level.astype(U64) * CELL)
        thrown = np.searchsorted(DARTS, word, "right")
        cell = np.repeat(np.arange(len(of)), thrown)
        nth = (np.arange(len(cell)) - np.repeat(np.cumsum(thrown) - thrown, thrown) + 1).astype(U64)
        rank = level[cell] + (mix(word[cell] + nth * DART) >> U64(11)) * 2.0**-53
        text = owner[of[cell]]
        low = rank < bound[text]
        place = (mix(word[cell][low] + nth[low] * PLACE) % U64(k)).astype(np.int64)
        np.minimum.at(out.reshape(-1), text[low] * k + place, rank[low])
        todo &= np.isinf(out).any(axis=1)  # a coordinate without a dart: raise the bound
        darts *= 4
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of each set."""
    bits = np.ascontiguousarray(signature).view(U64).reshape(len(signature), bands, -1)
    key = np.zeros(bits.shape[:2], U64) + mix(np.arange(1, bands + 1, dtype=U64) * PLACE)
    for j in range(bits.shape[2]):
        key = mix(key ^ bits[:, :, j])
    return key


#: Signatures made at once.
SIGNED_ROWS = 256


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        # a signature takes as much memory for a short text as for a long one
        for batch in slices(whole, "text", 1 << 20, SIGNED_ROWS):
            h, d, counts, digest = shingles(strings(batch, "text"))
            keys = band_keys(signatures(h, d, batch.num_rows)).view(np.int64)
            has = counts > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([x.tobytes() for x in digest], pa.binary()),
                 pa.array([k.tolist() if ok else [] for k, ok in zip(keys, has, strict=True)], pa.list_(pa.int64()))],
                ["doc_id", "__id", "__text", "digest", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 1 << 20):
            h, d, _, _ = shingles(strings(batch, "text"))
            cuts = np.searchsorted(d, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(cuts), pa.array(h.view(np.int64)))], ["node", "elements"])


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for all nodes of ``edges``
    (node, leader), by minimum labels and pointer jumping."""
    # both ends from one pass: a union would run what gives the edges twice
    ends = F.array(*[F.struct(F.col(a).alias("node"), F.col(b).alias("other"))
                     for a, b in (("node", "leader"), ("leader", "node"))])
    both = written(edges.select(F.inline(ends)), "edges")
    labels = written(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")), "labels")
    while True:
        seen = both.join(labels.toDF("other", "root"), "other").groupBy("node").agg(F.min("root").alias("near"))
        lower = labels.join(seen, "node").select("node", "root", F.least("root", "near").alias("next"))
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("after"))
        new = written(lower.join(jump, "next").select(
            "node", F.col("root").alias("was"), F.least("next", "after").alias("root")), "labels")
        changed = new.filter("was <> root").limit(1).count()
        labels = new.select("node", "root")
        if not changed:
            return labels


def merged_roots(roots: DataFrame | None, near: DataFrame) -> DataFrame:
    """``roots`` (node, root) after the links ``near`` came in: components of
    the graph of old roots, which is small once classes have formed."""
    if roots is not None and near.limit(1).count() == 0:
        return roots
    ends = near.select("node").union(near.select("leader")).toDF("node").distinct()
    if roots is None:
        old = ends.withColumn("root", F.col("node"))
    else:
        old = roots.unionByName(ends.join(roots, "node", "left_anti").withColumn("root", F.col("node")))
    old = written(old, "roots")
    edges = near.join(old, "node").select(F.col("root").alias("node"), "leader").join(
        old.toDF("leader", "other"), "leader").select("node", F.col("other").alias("leader")).filter("node <> leader").distinct()
    new = components(edges).toDF("root", "new")
    return written(old.join(new, "root", "left").select("node", F.coalesce("new", "root").alias("root")), "roots")


#: Bands are joined in these rounds.
BAND_ROUNDS = ((0, 4), (4, BANDS))


def tested_pairs(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (node, leader) with ``near``: weighted Jaccard on the sets
    themselves. Spark intersects the arrays (a set holds no element twice), so
    that a popular leader's pairs may be cut into many tasks and none starts Python."""
    same = F.size(F.array_intersect("elements", "others"))
    either = F.size("elements") + F.size("others") - same
    return written(
        pairs.join(sets, "node").join(sets.toDF("leader", "others"), "leader")
        .select("node", "leader", (same >= F.lit(float(threshold)) * either).alias("near")), "checked")


def class_roots(nodes: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """node, root for all nodes with a verified link to another text.

    In each bucket the smallest node leads and the others are verified against
    it, so a bucket of any size costs one pair a member. Where a bucket then
    still holds members of different classes, these meet again under their
    rarest shingles, which any two near texts share, and every two of
    different classes are compared there, inside tasks: first by sketches (a
    byte of each coordinate of the signatures), and by their sets within the
    families that agree as near sets do."""
    every = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    crowded = written(every.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"), "crowded")
    shared = written(every.join(crowded, "bucket"), "buckets")
    wanted = written(shared.select("node").distinct().join(nodes.select("node", "__id", "__text"), "node"), "wanted")
    texts = docs.select(*row_key(), F.col("text")).join(
        sized(wanted, wanted.count()), ["__id", "__text"]).select("node", "text")
    # a row repeated in the table gives its set several times; one stays
    sets = written(texts.mapInArrow(tidy(_sets), "node long, elements array<long>").dropDuplicates(["node"]), "sets")

    def verified(members: DataFrame, tested: DataFrame | None) -> DataFrame:
        """Pairs of members with their bucket's leader that are of different
        classes and were not tested before, with their result."""
        leaders = written(members.groupBy("bucket").agg(F.min(F.struct("node", "root")).alias("first")).select(
            "bucket", F.col("first.node").alias("leader"), F.col("first.root").alias("leader_root")), "leaders")
        pairs = members.join(leaders, "bucket").filter("root <> leader_root").select("node", "leader").distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("node", "leader"), ["node", "leader"], "left_anti")
        return tested_pairs(pairs, sets, threshold)

    def rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
        return members.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))

    def mixed(members: DataFrame) -> DataFrame:
        """The buckets that hold members of different classes."""
        members = written(members, "left")
        several = members.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter(
            "a <> b").select("bucket")
        return written(members.join(several, "bucket"), "members")

    # A class of many copies meets in all bands: a few bands first, so that the others find it whole.
    tested, roots = None, None
    for first, last in BAND_ROUNDS:
        members = shared.filter(F.col("band").between(first, last - 1)).select("bucket", "node")
        members = members.withColumn("root", F.col("node")) if roots is None else mixed(rooted(members, roots))
        checked = verified(members, tested)
        tested = checked if tested is None else tested.unionByName(checked)
        roots = merged_roots(roots, checked.filter("near").select("node", "leader"))

    # What still meets members of other classes, often through a passage that
    # many texts share: links among these show in their rare shingles as well.
    open_nodes = mixed(rooted(shared.select("bucket", "node"), roots)).select("node").distinct()
    open_sets = written(sets.join(open_nodes, "node"), "open")
    rare = rare_elements(open_sets, threshold)
    members = unlike(mixed(rooted(rare, roots)))
    sketches = sketched(open_sets, members)

    # Sketches first name few links that would join most classes. Then texts
    # of different classes that may be near, directly or through others, form
    # a family, and each set is sent once, to its family.
    def named(least: float, families: bool) -> DataFrame:
        return written(in_buckets(members, F.lit(1), BLOCK_SKETCHES, sketches,
                                  lambda t: _forest(t, threshold, least, families), "node long, leader long"), "named")

    checked = tested_pairs(named(K * threshold, False), open_sets, threshold)
    roots = merged_roots(roots, checked.filter("near").select("node", "leader"))
    members = mixed(rooted(members.select("bucket", "node"), roots))
    families = components(named(least_agreeing(threshold), True)).toDF("node", "bucket")
    relatives = mixed(rooted(families, roots)).join(sketches.select("node", "size"), "node")
    found = written(in_buckets(relatives, F.col("size"), BLOCK_ELEMENTS, open_sets,
                               lambda t: _linked(t, threshold), "node long, leader long"), "compared")
    return merged_roots(roots, found)


def unlike(members: DataFrame) -> DataFrame:
    """One bucket of those that hold the same nodes: shingles that lie side by
    side are mostly shared by the same texts, which need comparing once. (The
    number of nodes, their ends, and the sum and exclusive-or of their hashes
    stand for them.)"""
    word = F.xxhash64("node")
    lists = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"),
        F.sum(word.cast("decimal(20,0)")).alias("sum"), F.bit_xor(word).alias("xor"))
    chosen = written(lists.groupBy("n", "low", "high", "sum", "xor").agg(F.min("bucket").alias("bucket")).select("bucket"),
                     "unlike")
    return written(members.join(chosen, "bucket"), "members")


def in_buckets(members: DataFrame, weight: F.Column, block: int, values: DataFrame,
               compare: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Distinct rows of ``compare`` over the buckets of ``members`` (bucket,
    node, root) with the ``values`` of their nodes. A bucket whose weights sum
    to more than ``block`` is dealt over all pairs of its blocks of half as much."""
    sizes = written(members.groupBy("bucket").agg(F.sum(weight).alias("n")), "sizes")
    blocks = F.when(F.col("n") <= block, 1).otherwise(F.ceil(F.col("n") / (block // 2)).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = members.join(sizes.select("bucket", blocks.alias("blocks")), "bucket").select(
        "bucket", "node", "root", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
            F.least(own, other.cast("int")).alias("a"), F.greatest(own, other.cast("int")).alias("b")))).alias("part"))
    return placed.select("bucket", "part.a", "part.b", "node", "root").join(values, "node").groupBy(
        "bucket", "a", "b").applyInArrow(compare, schema).distinct()


#: Sketches (K bytes each) and elements of sets (8 bytes each) that one task compares at once.
BLOCK_SKETCHES, BLOCK_ELEMENTS = 4096, 1 << 21


def least_agreeing(threshold: float) -> float:
    """Coordinates on which two sets at the threshold agree at least, but for
    one pair in a billion: 6.5 standard deviations below the mean."""
    return K * threshold - 6.5 * math.sqrt(K * threshold * (1 - threshold))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One byte of each coordinate of the signature."""
    for whole in batches:
        for begin in range(0, whole.num_rows, SIGNED_ROWS):
            batch = whole.slice(begin, SIGNED_ROWS)
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            signed = signatures(lists.flatten().to_numpy().view(U64), np.repeat(np.arange(len(sizes)), sizes), len(sizes))
            low = mix(np.ascontiguousarray(signed).view(U64)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array([x.tobytes() for x in low], pa.binary())],
                ["node", "size", "sketch"])


def sketched(sets: DataFrame, members: DataFrame) -> DataFrame:
    """node, size, sketch of the nodes of ``members``."""
    return written(sets.join(members.select("node").distinct(), "node").select("node", "elements").mapInArrow(
        tidy(_sketches), "node long, size int, sketch binary"), "sketches")


def _forest(group: pa.Table, threshold: float, least: float, families: bool) -> pa.Table:
    """Links between classes whose sketches agree in ``least`` places, fewer
    than members. For ``families``, where only what hangs together counts, each
    member is linked to the smallest of its tree: buckets that hold the same
    members, as the shingles of one passage do, then give the same links."""
    sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(group.num_rows, K)
    nodes, size, found = group["node"].to_pylist(), group["size"].to_numpy(), []
    _, root = np.unique(group["root"].to_numpy(), return_inverse=True)
    # links found join single members: whole classes may hold others that are not alike
    label = np.arange(len(nodes))
    # of two members of different classes, one is not in the largest class
    for i in np.flatnonzero(root != np.bincount(root).argmax()).tolist():
        fits = np.minimum(size, size[i]) >= threshold * np.maximum(size, size[i])
        near = np.flatnonzero((root != root[i]) & (label != label[i]) & fits)
        for j in near[np.count_nonzero(sketch[near] == sketch[i], axis=1) >= least].tolist():
            if label[j] != label[i]:
                found.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
                label[label == label[j]] = label[i]
    if families:
        ends = np.array(nodes, np.int64)
        least_of = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(least_of, label, ends)
        away = np.flatnonzero(least_of[label] != ends)
        found = list(zip(ends[away].tolist(), least_of[label][away].tolist(), strict=True))
    return links(found)


def _linked(group: pa.Table, threshold: float) -> pa.Table:
    """Links between the classes of a group: each set outside the
    largest class is compared with all, and classes found near are one from then on."""
    nodes = group["node"].to_pylist()
    sets = [x.values.to_numpy() for x in group["elements"]]
    sizes = np.array([len(x) for x in sets])
    every = np.concatenate(sets)
    _, label = np.unique(np.array(group["root"].to_pylist(), np.int64), return_inverse=True)
    order = np.argsort(every, kind="stable")
    ranked, of = every[order], np.repeat(np.arange(len(sets)), sizes)[order]
    found = []
    largest = np.bincount(label).argmax()
    # of two sets of different classes, one is not in the largest class
    for i in np.flatnonzero(label != largest).tolist():
        own = sets[i]
        first, last = np.searchsorted(ranked, own, "left"), np.searchsorted(ranked, own, "right")
        n = last - first
        hits = of[np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        same = np.bincount(hits, minlength=len(sets))
        for j in np.flatnonzero(same >= threshold * (sizes + sizes[i] - same)).tolist():
            if label[j] != label[i]:
                found.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
                label[label == label[j]] = label[i]
    return links(found)


def links(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                    names=["node", "leader"])


def rare_elements(sets: DataFrame, threshold: float) -> DataFrame:
    """bucket, node: each set under its rarest elements, as many as two sets
    at the threshold cannot all differ in (prefix filter: of n elements,
    n - ceil(threshold n) + 1 in one order for all sets). Elements of one set
    only meet nobody and are left out."""
    every = written(sets.select("node", F.size("elements").alias("n"), F.explode("elements").alias("bucket")), "elements")
    times = written(every.groupBy("bucket").agg(F.count("*").alias("times")), "times")
    order = Window.partitionBy("node").orderBy("times", "bucket")
    ranked = every.join(times, "bucket").withColumn("place", F.row_number().over(order))
    most = F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9) + 1
    return written(ranked.filter((F.col("place") <= most) & (F.col("times") > 1)).select("bucket", "node"), "rare")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the smallest doc_id of
    its class), class_size, kept.

    Texts of equal word sequences are one node. A null, empty or wordless text
    has no shingles and is a class of its own; a text of fewer than five words
    is one shingle. Rows without doc_id take part; a class of such rows only
    has a null class_id. Rows repeated with the same doc_id and text are in
    one class, and each of them that is the class's row says kept. An empty
    table gives no rows. Only doc_id and text are read."""
    rows = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), "text")
        .mapInArrow(tidy(_sign), "doc_id long, __id long, __text long, digest binary, bands array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "signed")
    # one node per word sequence, its first row (nulls, coded as the smallest id, must not win)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "__id", "__text", "row")).alias("first")
    wordy = rows.filter(F.size("bands") > 0)
    groups = wordy.groupBy("digest").agg(first, F.count("*").alias("n"))
    nodes = written(
        groups.select("digest", "n", "first", F.col("first.row").alias("node")).join(
            rows.select(F.col("row").alias("node"), "bands"), "node").select(
            "node", "digest", "n", "first", F.col("first.__id").alias("__id"), F.col("first.__text").alias("__text"),
            "bands"), "nodes")
    roots = class_roots(nodes, docs, threshold)
    classed = nodes.select("node", "digest", "n", "first").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    classes = classed.groupBy("root").agg(F.sum("n").alias("class_size"), F.min("first").alias("best"))
    by_digest = classed.join(classes, "root").select(
        "digest", "best", "class_size")
    alone = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("__id"), F.col("__text"), F.col("row"))
    out = rows.withColumn("digest", F.when(F.size("bands") > 0, F.col("digest"))).drop("bands").join(
        by_digest, "digest", "left").withColumn("best", F.coalesce("best", alone))
    return out.select(
        "doc_id", F.when(~F.col("best.no_id"), F.col("best.__id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        ((F.col("__id") == F.col("best.__id")) & (F.col("__text") == F.col("best.__text"))).alias("kept"),
        "__id", "__text")


COLUMNS = ["doc_id", "class_id", "class_size", "kept"]


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, all columns."""
    found = written(near_duplicates(docs, threshold), "near")
    repeated = found.filter("kept").groupBy("__id", "__text").count().filter("count > 1").limit(1).count() > 0
    return without(docs, found.filter("not kept").select("__id", "__text"), repeated)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(COLUMNS)
