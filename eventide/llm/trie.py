"""Conversation prefix trie with subtree totals by parallel tree contraction
(Miller and Reif, 1985).

**The trie.** A prefix of a conversation is named by a fingerprint modulo
2**127 - 1 of its turns' digests, so equal prefixes of any two conversations are
one node without a conversation ever being gathered in one place: turns are
range-sorted, every partition scans its own, and what a conversation holds in
earlier partitions is added afterwards from two rows a partition.

**Totals.** Rounds of joins alternate between *rake* (all leaves go, their
totals are added up by parent) and *compress* (of every unary chain an
independent set of nodes is spliced out, chosen by coins on the nodes' ids: a
node goes if its coin shows heads and its child's tails). A spliced node leaves
what its total adds to its child's. A round takes all leaves and a quarter of
every chain, so a logarithmic number of rounds ends it, however wide or deep the
tree. Then the spliced nodes are expanded again: they follow their links, which
double in every join, down to a raked node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Field and base of the fingerprints (a Mersenne prime; any well mixed base).
PRIME = (1 << 127) - 1
BASE = 0x5BD1E9955BD1E995C6A4A7935BD1E995

#: Conversations lie in blocks of so many ids; the first of a block lends its first turns.
BLOCK = 100
#: Most turns that are lent, plus one.
LENT = 6
#: Ids in one piece of a list to be hashed.
CHUNK = 256


def split(value: int) -> tuple[int, int]:
    """A number below 2**127 as two longs (the low one shifted to be signed)."""
    return value >> 64, (value & (1 << 64) - 1) - (1 << 63)


def joined(high: int, low: int) -> int:
    return (high << 64) + low + (1 << 63)


#: The fingerprint of the empty prefix.
NOTHING = split(0)


# ---- ordered scan -----------------------------------------------------------

SCANNED = ("part int, conv_id long, at long, n_chars long, high long, low long, was_high long, was_low long, "
           "edge boolean, opens boolean")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each turn among those of its conversation in this partition,
    the fingerprint up to it and the one before it. ``edge``: the last turn of
    the partition's first conversation (``opens``) or of its last one."""
    current, state, at, begun = None, 0, 0, False
    held, held_opens = None, True

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), *[pa.int64()] * 7, pa.bool_(), pa.bool_()]
        names = [c.split()[0] for c in SCANNED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        rows = []
        for part, conv, n_chars, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not begun or conv != current:
                if held is not None:  # a turn is given out once it is known whether it is its conversation's last here
                    rows.append((*held, held_opens, held_opens))
                    held, held_opens = None, False
                current, state, at, begun = conv, 0, 0, True
            if held is not None:
                rows.append((*held, False, held_opens))
            was, state = state, (state * BASE + joined(a, b) + 1) % PRIME
            held = (part, conv, at, n_chars, *split(state), *split(was))
            at += 1
        if rows:
            yield batch_of(rows)
    if held is not None:
        yield batch_of([(*held, True, held_opens)])


def carries(edges: list) -> list[tuple]:
    """For each partition whose first conversation began earlier: (part,
    conv_id, turns before, fingerprint before). ``edges`` are at most two rows
    a partition."""
    out, conv, turns, state = [], None, 0, 0
    for e in sorted(edges, key=lambda e: (e.part, not e.opens)):
        continues = e.opens and turns and e.conv_id == conv
        if continues:
            out.append((e.part, e.conv_id, turns, *split(state)))
        n, own = e.at + 1, joined(e.high, e.low)
        conv, turns, state = e.conv_id, (turns if continues else 0) + n, (
            (state if continues else 0) * pow(BASE, n, PRIME) + own) % PRIME
    return out


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (0, 1 ...), n_chars, high, low, was_high, was_low: the turns
    of every conversation in order, with the fingerprints of the prefixes that
    end at and before them."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    half = lambda k: F.conv(F.substring(digest, k, 15), 16, 10).cast("long")
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.length(text).cast("long").alias("n_chars"), half(1).alias("a"), half(16).alias("b"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("a"), F.col("b")]
    scanned = written(
        turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
            F.spark_partition_id().alias("part"), "conv_id", "n_chars", "a", "b").mapInArrow(_scan, SCANNED), "scanned")
    before = spark.createDataFrame(carries(scanned.filter("edge").collect()),  # two rows a partition
                                   "part int, conv_id long, turns long, by_high long, by_low long")
    placed = scanned.join(F.broadcast(before), ["part", "conv_id"], "left")

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "at", "n_chars", "high", "low", "was_high", "was_low"]
        for batch in batches:
            rows = []
            for conv, at, n_chars, h, l, wh, wl, turns, bh, bl in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if turns is not None:
                    was = joined(bh, bl) * pow(BASE, at, PRIME) % PRIME
                    h, l = split((joined(h, l) + was * BASE) % PRIME)
                    wh, wl = split((joined(wh, wl) + was) % PRIME)
                rows.append((conv, at + (turns or 0), n_chars, h, l, wh, wl))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else
                                             [pa.array([], pa.int64())] * 7, names)

    return written(placed.select("conv_id", "at", "n_chars", "high", "low", "was_high", "was_low", "turns", "by_high",
                                 "by_low").mapInArrow(moved, ", ".join(
                                     f"{c} long" for c in ("conv_id", "at", "n_chars", "high", "low", "was_high", "was_low"))),
                   "turns")


# ---- rebuilt conversations --------------------------------------------------

MEMBER = ["depth", "high", "low", "was_high", "was_low", "conv_id", "n_chars", "ends"]


def rebuilt_members(turns: DataFrame) -> DataFrame:
    """One row per prefix of every rebuilt conversation, the empty one
    included: the prefix (depth, high, low), the one before it, conv_id, code
    points of its last text, whether the conversation ends there. A conversation
    is the first h turns of its block's first one, then its own after its first h."""
    head = [F.max(F.when(F.col("at") == k, F.struct("high", "low", "n_chars"))).alias(f"t{k}") for k in range(LENT - 1)]
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    heads = turns.filter(F.col("at") < LENT - 1).groupBy("conv_id").agg(*head)
    convs = written(sizes.join(heads, "conv_id").select(
        "conv_id", "n", F.array(*(f"t{k}" for k in range(LENT - 1))).alias("head"),
        F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(LENT)).cast("int").alias("h"),
        (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base")), "heads")
    lent = convs.select(F.col("conv_id").alias("base"), F.col("head").alias("lent"))
    convs = written(convs.join(lent, "base", "left").withColumn(
        "lent", F.filter(F.slice(F.coalesce("lent", F.array().cast("array<struct<high:long,low:long,n_chars:long>>")),
                                 1, LENT - 1), lambda t: t.isNotNull()))
        .withColumn("lent", F.expr("slice(lent, 1, h)"))
        .withColumn("own", F.expr("if(h > 0 and n >= h, head[h - 1], null)")).drop("head"), "convs")

    empty = F.struct(*(F.lit(v).cast("long").alias(c) for v, c in zip((*NOTHING, 0), ("high", "low", "n_chars"), strict=True)))
    first = convs.select(
        "conv_id", "h", "n", F.posexplode(F.concat(F.array(empty), F.col("lent"))).alias("depth", "t"),
        F.concat(F.array(empty), F.col("lent")).alias("all")).select(
        F.col("depth").cast("long").alias("depth"), "t.high", "t.low",
        F.expr("all[greatest(depth - 1, 0)].high").alias("was_high"),
        F.expr("all[greatest(depth - 1, 0)].low").alias("was_low"), "conv_id", "t.n_chars",
        ((F.col("depth") == F.size("all") - 1) & (F.col("n") <= F.col("h"))).alias("ends"))

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Own turns behind the lent ones: F(own) + (F(lent) - F(own first h)) * BASE**(turns since)."""
        for batch in batches:
            rows = []
            for conv, at, n_chars, h, l, wh, wl, n, skip, lent, oh, ol, lh, ll in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                delta = (joined(lh, ll) - joined(oh, ol)) * pow(BASE, at - skip, PRIME)
                key, was = (joined(h, l) + delta * BASE) % PRIME, (joined(wh, wl) + delta) % PRIME
                rows.append((lent + at - skip + 1, *split(key), *split(was), conv, n_chars, at == n - 1))
            kinds = [pa.int64()] * 7 + [pa.bool_()]
            columns = zip(*rows, strict=True) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], MEMBER)

    own = F.when(F.col("own").isNull(), empty).otherwise(F.col("own"))
    last = F.when(F.size("lent") > 0, F.expr("lent[size(lent) - 1]")).otherwise(empty)
    rest = turns.join(convs, "conv_id").filter(F.col("at") >= F.col("h")).select(
        "conv_id", "at", "n_chars", "high", "low", "was_high", "was_low", "n", "h", F.size("lent").alias("lent"),
        own.high.alias("own_high"), own.low.alias("own_low"), last.high.alias("lent_high"), last.low.alias("lent_low"))
    rest = rest.mapInArrow(shifted, "depth long, high long, low long, was_high long, was_low long, conv_id long, "
                                    "n_chars long, ends boolean")
    return written(first.select(*MEMBER).unionByName(rest), "members")


# ---- tree contraction -------------------------------------------------------


def coin(node: Column, turn: int) -> Column:
    return F.xxhash64(node, F.lit(turn)).bitwiseAND(1) == 1


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """node and, for each of ``values``, its sum over the node's subtree, for
    trees given as (node, parent, values...); a root's parent is null."""
    acc, edge = [f"a_{v}" for v in values], [f"w_{v}" for v in values]
    zero = F.lit(0).cast("long")
    active = written(tree.select("node", "parent", *(F.col(v).cast("long").alias(a) for v, a in zip(values, acc, strict=True)),
                                 *(zero.alias(w) for w in edge)), "active")
    raked, spliced, turn = [], [], 0
    while active.limit(1).count():
        # rake: leaves are done and send their totals up
        kids = active.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"))
        split_up = written(active.join(kids, "node", "left"), "kids")
        leaves, inner = split_up.filter("kids is null"), split_up.filter("kids is not null").drop("kids")
        raked.append(leaves.select("node", *(F.col(a).alias(v) for v, a in zip(values, acc, strict=True))))
        sent = leaves.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            *(F.sum(F.col(a) + F.col(w)).alias(f"s_{v}") for v, a, w in zip(values, acc, edge, strict=True)))
        inner = written(inner.join(sent, "node", "left").select(
            "node", "parent", *((F.col(a) + F.coalesce(f"s_{v}", zero)).alias(a) for v, a in zip(values, acc, strict=True)),
            *edge), "raked")
        # compress: an independent set of each unary chain goes, its child hangs on its parent
        only = inner.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            F.count("*").alias("kids"), F.min("node").alias("child"))
        out = (F.col("kids") == 1) & F.col("parent").isNotNull() & coin(F.col("node"), turn) & ~coin(F.col("child"), turn)
        chains = written(inner.join(only, "node", "left").withColumn("out", F.coalesce(out, F.lit(False))), "chains")
        gone = chains.filter("out").select(
            F.col("child").alias("node"), F.col("node").alias("gone"), F.col("parent").alias("above"),
            *(F.col(a).alias(f"g_{v}") for v, a in zip(values, acc, strict=True)),
            *(F.col(w).alias(f"h_{v}") for v, w in zip(values, edge, strict=True)))
        linked = written(chains.filter("not out").drop("kids", "child", "out").join(gone, "node", "left"), "linked")
        spliced.append(linked.filter("gone is not null").select(
            F.col("gone").alias("node"), F.col("node").alias("child"),
            *((F.col(f"g_{v}") + F.col(w)).alias(v) for v, w in zip(values, edge, strict=True))))
        active = linked.select(
            "node", F.when(F.col("gone").isNotNull(), F.col("above")).otherwise(F.col("parent")).alias("parent"), *acc,
            *((F.col(w) + F.coalesce(F.col(f"g_{v}") + F.col(f"h_{v}"), zero)).alias(w)
              for v, w in zip(values, edge, strict=True)))
        turn += 1
    if not raked:
        return tree.select("node", *(F.col(v).cast("long").alias(v) for v in values))
    done = reduce(DataFrame.unionByName, raked)
    # expand: links double until they end at raked nodes
    links = written(reduce(DataFrame.unionByName, spliced), "links")
    while True:
        ahead = links.select(F.col("node").alias("child"), F.col("child").alias("after"),
                             *(F.col(v).alias(f"n_{v}") for v in values))
        jumped = written(links.join(ahead, "child", "left"), "links")
        more = jumped.filter("after is not null").limit(1).count()
        links = jumped.select("node", F.coalesce("after", "child").alias("child"),
                              *((F.col(v) + F.coalesce(f"n_{v}", zero)).alias(v) for v in values))
        if not more:
            break
    ends = done.select(F.col("node").alias("child"), *(F.col(v).alias(f"n_{v}") for v in values))
    expanded = links.join(ends, "child").select("node", *((F.col(v) + F.col(f"n_{v}")).alias(v) for v in values))
    return done.unionByName(expanded)


# ---- digests of id lists ----------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (part, depth, high, low, conv_id) as pieces of comma-joined lists."""
    key, ids, nth = None, [], 0

    def piece() -> tuple:
        return (*key, nth, ",".join(ids))

    for batch in batches:
        rows = []
        for *own, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key or len(ids) == CHUNK:
                if ids:
                    rows.append(piece())
                key, ids, nth = own, [], nth + 1
            ids.append(str(conv))
        yield _pieces(rows)
    if ids:
        yield _pieces([piece()])


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.int64()] * 4, pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                      ["part", "depth", "high", "low", "nth", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each list, from its pieces in order."""
    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                          ["depth", "high", "low", "ends_sha256"])

    key, state = None, None
    for batch in batches:
        rows = []
        for *own, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                if state is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield out(rows)
    if state is not None:
        yield out([(*key, state.hexdigest())])


def id_list_digests(members: DataFrame) -> DataFrame:
    """depth, high, low, ends_sha256 over the conv_ids of each node, ascending.
    The list is cut over many tasks into pieces; a digest is one chain by its
    nature, so one task takes a node's pieces, holding one batch."""
    node = ["depth", "high", "low"]
    sorted_ids = members.select(*node, "conv_id").repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id")
    pieces = sorted_ids.select(F.spark_partition_id().alias("part"), *node, "conv_id").mapInArrow(
        _chunks, "part int, depth long, high long, low long, nth long, ids string")
    return pieces.repartition(*node).sortWithinPartitions(*node, "part", "nth").select(*node, "ids").mapInArrow(
        _hashed, "depth long, high long, low long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A null role or text is empty; a null turn comes first; turns of one number
    are ordered by role, then by the digest that stands for role and text, and
    repeated rows are turns of their own. Rows without conv_id belong to no conversation and are
    left out. Texts of any length count whole. An empty table gives no rows. Only
    conv_id, turn, role and text are read, so further columns do no harm."""
    members = rebuilt_members(ordered_turns(conversations))
    node = ["depth", "high", "low"]
    nodes = written(members.groupBy(*node).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("n_chars").alias("n_chars"),
        F.min("was_high").alias("was_high"), F.min("was_low").alias("was_low"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("high").alias("was_high"), F.col("low").alias("was_low"),
                         F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = written(nodes.join(above, ["depth", "was_high", "was_low"], "left"), "linked")
    children = linked.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    tree = written(linked.join(children, "node", "left").select(
        *node, "node", "parent", "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens")), "tree")
    totals = subtree_totals(tree.select("node", "parent", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"])
    digests = id_list_digests(members.filter("ends"))
    return tree.drop("n_leaves", "saved_tokens").join(totals, "node").join(digests, node, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


SQL = r"""
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''),
                         sha256(concat(strlen(coalesce(role, '')), ':', role, text))) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), bits AS (
  SELECT conv_id, own, list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(conv_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda b: (ascii(c)::BIGINT >> b) & 1)))) AS bits
  FROM turns
), lent AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base, xor(list_reduce(bits, lambda a, b:
    xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)), 4294967295::BIGINT) % 6 AS h
  FROM bits
), rebuilt AS (
  SELECT l.conv_id, list_concat(coalesce(b.own, [])[1:l.h], l.own[l.h + 1:]) AS path
  FROM lent l LEFT JOIN turns b ON b.conv_id = l.base
), prefixes AS (
  SELECT conv_id, d AS depth, path[1:d] AS path, len(path) = d AS ends
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, path
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c
         WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children,
       CAST(count(*) FILTER (WHERE s.n_children = 0) AS BIGINT) AS n_leaves,
       CAST(sum(CASE WHEN s.depth = 0 THEN 0 ELSE (s.n_convs - 1) * length(s.path[s.depth].text) END) AS BIGINT)
         AS saved_tokens, n.ends_sha256
FROM linked n JOIN linked s ON s.depth >= n.depth AND s.path[1:n.depth] = n.path
GROUP BY ALL
"""
