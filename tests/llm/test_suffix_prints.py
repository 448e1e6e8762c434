"""Different strings that share a 64-bit polynomial hash for any odd base (Thue and Morse) are no repeats."""

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from eventide.llm import suffix  # noqa: E402
from eventide.llm.common import importable  # noqa: E402


def test_equal_polynomial_hash_is_no_repeat(spark):
    importable(spark)
    draw = random.Random(5)
    letters = lambda n: "".join(draw.choices("abcdefgh ", k=n))
    morse = [k.bit_count() % 2 for k in range(2048)]
    before, after = letters(12000), letters(12000)
    rows = [(k, before + "".join(ab[m] for m in morse) + after) for k, ab in enumerate(("ab", "ba"))]
    found = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 8000).drop("removed")
    assert sorted(map(tuple, found.collect())) == sorted(brute.repeats(rows, 8000))
