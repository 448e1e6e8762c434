"""Copies that differ in one byte: the byte that no repeated string holds stays."""

import os
import random
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from eventide.llm import suffix  # noqa: E402
from eventide.llm.common import importable  # noqa: E402

LETTERS = "abcdefghijklmnopqrstuvwxyz "


def edited(offsets, size, seed):
    """A text and its copy with another byte at the offset, for each offset."""
    draw = random.Random(seed)
    out = []
    for k, p in enumerate(offsets):
        text = "".join(draw.choices(LETTERS, k=size))
        out += [(2 * k, text), (2 * k + 1, text[:p] + "#" + text[p + 1:])]
    return out


def agrees(spark, rows, length):
    importable(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix.remove_repeats(docs, length).drop("removed").collect()
    wrong = set(map(tuple, found)) ^ set(brute.repeats(rows, length))
    assert not wrong, f"{len({w[0] for w in wrong})} of {len(rows)} rows"


def test_one_byte_edits_at_all_offsets(spark):
    agrees(spark, edited(range(600), 600, 1), 40)


def test_one_byte_edits_of_an_odd_length(spark):
    agrees(spark, edited(range(0, 600, 3), 600, 2), 41)


def test_no_byte_lies_between_anchors():
    data = np.random.default_rng(3).integers(97, 123, 1 << 20).astype(np.uint8)
    at, _ = suffix.anchors(data, 400)
    assert np.diff(at).max() <= 400 // 2
