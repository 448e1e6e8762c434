"""Clashing column names in the pipeline's stages, and near-duplicate classes
against all pairs on a whole table."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from eventide.llm import exact_dedup, minhash, quality  # noqa: E402
from eventide.llm.common import importable, table  # noqa: E402

CLASH = "doc_id long, text string, __id long, __text long, score double, score_ int, hash string, size int, bands int"


def test_clashing_names(spark):
    importable(spark)
    rows = [(i, f"some words that are told here again and again number {i // 2}", 5, 6, 0.5, 1, "h", 2, 3) for i in range(8)]
    docs = spark.createDataFrame(rows, CLASH)
    labels = spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, quality int")
    for kept, n in ((exact_dedup.drop_copies(docs), 4), (minhash.drop_near_copies(docs), 4),
                    (quality.keep_good(docs, labels), 8)):
        assert kept.columns == docs.columns
        found = kept.collect()
        assert len(found) == n and {tuple(r) for r in found} <= set(rows)


def test_classes_against_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    want = brute.near_classes([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).select("doc_id", "class_id").collect()}
    linked = [d for d, c in want.items() if c != d]
    assert len(linked) > 50
    missed = [d for d in linked if got[d] != want[d]]
    assert len(missed) <= 0.1 * len(linked), f"recall {1 - len(missed) / len(linked)}"
    assert sum(got[d] != want[d] for d in want) <= 0.1 * len(linked)  # and nothing else is joined
