"""Super-k-mer removal, prefix trie and periodic runs against brute force, with
nulls, empty texts, ties, repeated rows, hot keys and clashing extra columns."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from eventide.llm import periodic, superkmer, trie  # noqa: E402
from eventide.llm.common import importable, table  # noqa: E402

SF = "/root/testdata/sf0.001"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows(spark):
    importable(spark)
    rng = random.Random(3)
    found = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").limit(60).collect()]
    some = lambda letters, n: " ".join(rng.choice(letters) for _ in range(n))
    passage = some("abcdefgh", 30)  # held by many texts in different surroundings
    found += [(1000 + i, f"{some('xyzuv', 20)} {passage} {some('xyzuv', 25)}") for i in range(50)]
    return found + [(2000, None), (2001, ""), (2002, " \t\n"), (None, found[3][1]), (None, found[3][1]),
                    (2003, found[5][1]), (2003, found[5][1]), (found[5][0], "a b"), (2004, "w " * 3000),
                    (2005, "w\x0b" * 2000), (2006, "w\u00a0w " * 30), (2007, "x" * 5000)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    extra = [(d, t, "x", 1, 2, [3]) for d, t in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, sha string, tid long, name long, names array<long>")


@pytest.mark.parametrize("size,hot_bytes", [(50, 1 << 20), (12, 300), (3, 500), (1, 1 << 20)])
def test_windows(docs, rows, size, hot_bytes):
    found = superkmer.remove_windows(docs, size, hot_bytes).drop("removed")
    assert got(found) == sorted(brute.earlier_windows(rows, size), key=str)


def test_sorted_windows_do_not_depend_on_hashes():
    import numpy as np

    ids = np.array([random.Random(1).randrange(2) for _ in range(500)])
    for size in (1, 2, 3, 7, 50):
        ranks = superkmer.sorted_windows(ids, size)
        parts = [tuple(ids[i:i + size].tolist()) for i in range(len(ids) - size + 1)]
        order = {p: k for k, p in enumerate(sorted(set(parts)))}
        assert [order[p] for p in parts] == ranks.tolist()


def test_runs_by_kruskal():
    rng = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = [str(rng.randint(1, rng.choice([1, 2, 3, 6]))) for _ in range(rng.randint(0, 60))]
            if words and rng.random() < 0.6:
                a, p = rng.randrange(len(words)), rng.randint(1, 9)
                words = [words[i] if i < a else words[min(a + (i - a) % p, len(words) - 1)] for i in range(len(words))]
            texts.append(words)
        for words, row in zip(texts, periodic._documents(range(len(texts)), [" ".join(t) for t in texts], None), strict=True):
            assert [(r["start"], r["length"], r["period"]) for r in row[-1]] == brute.runs(words)


def test_fibonacci_words_have_many_runs():
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    (row,) = periodic._documents([1], [" ".join(b)], None)
    assert [(r["start"], r["length"], r["period"]) for r in row[-1]] == brute.runs(b) and row[0] > 50


def test_runs(docs, rows):
    found = got(periodic.find_runs(docs, periodic.periodic_tail).drop("runs"))
    assert found == sorted((brute.run_row(d, t) for d, t in rows), key=str)
    assert any(r[2] is not None for r in found) and any(r[2] is None for r in found)


TREE = "node long, parent long, v long"


@pytest.mark.parametrize("kind", ["random", "chain", "star", "caterpillar"])
def test_subtree_totals(spark, kind):
    rng, n = random.Random(2), 70
    above = {"random": rng.randrange, "chain": lambda i: i - 1, "star": lambda i: 0,
             "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2)}[kind]
    parents = [None] + [above(i) for i in range(1, n)]
    values = [rng.randint(-5, 9) for _ in range(n)]
    want = list(values)
    for i in range(n - 1, 0, -1):
        want[parents[i]] += want[i]
    tree = spark.createDataFrame(list(zip(range(n), parents, values, strict=True)), TREE)
    assert got(trie.subtree_totals(tree, ["v"])) == sorted(enumerate(want), key=str)


def test_trie(spark):
    importable(spark)
    rng, rows = random.Random(5), []
    for c in [*range(0, 260, 9), -5, -200, 1000000007, 5000]:
        for t in range(rng.choice([1, 2, 3, 5, 8, 20])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["u", "a", None]), rng.choice(["x", "yé", "zzz", None, ""])))
    rows += [(77, t, "u", "abc"[t % 3] * (t % 5)) for t in range(150)]  # one long conversation, over several partitions
    rows += [(None, 1, "u", "q"), rows[5], rows[5]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, part int, depth string").repartition(7)
    assert got(trie.prefix_trie(df)) == sorted(brute.trie(rows), key=str)


def test_scan_carries_over_partitions():
    from types import SimpleNamespace as Edge

    whole = trie.carries([Edge(part=0, conv_id=1, at=1, high=0, low=5 - (1 << 63), opens=True),
                          Edge(part=1, conv_id=1, at=2, high=0, low=7 - (1 << 63), opens=True),
                          Edge(part=2, conv_id=1, at=0, high=0, low=1 - (1 << 63), opens=True),
                          Edge(part=2, conv_id=2, at=3, high=0, low=9 - (1 << 63), opens=False),
                          Edge(part=3, conv_id=3, at=0, high=0, low=9 - (1 << 63), opens=True)])
    assert [(p, c, n) for p, c, n, _, _ in whole] == [(1, 1, 2), (2, 1, 5)]
    assert trie.joined(*whole[1][3:]) == (5 * pow(trie.BASE, 3, trie.PRIME) + 7) % trie.PRIME


def test_empty(spark, docs):
    talks = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for df in (superkmer.remove_windows(docs.limit(0)), periodic.find_runs(docs.limit(0)), trie.prefix_trie(talks)):
        assert df.count() == 0
