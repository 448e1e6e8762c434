"""The hypergeometric matrix against enumeration, at small and very large
sizes; the classifier's sample bounds and its accuracy on the held-out fold."""

import math
import os
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventide.llm import quality, sharding  # noqa: E402
from eventide.llm.common import importable, table  # noqa: E402


@pytest.mark.parametrize("good,bad,n", [(5, 3, 4), (1, 9, 10), (0, 6, 3), (7, 0, 3), (40, 60, 0), (300, 500, 250), (2, 10**6, 9)])
def test_law_by_enumeration(good, bad, n):
    first, law = sharding.hypergeometric_law(good, bad, n)
    total = math.comb(good + bad, n)
    for k in range(max(0, n - bad), min(n, good) + 1):
        exact = math.comb(good, k) * math.comb(bad, n - k) / total
        found = law[k - first] if 0 <= k - first < len(law) else 0.0
        assert math.isclose(found, exact, rel_tol=1e-9, abs_tol=1e-30)


def test_law_of_large_numbers_of_places():
    good, bad, n = 4 * 10**12, 92 * 10**12 + 7, 200_000
    first, law = sharding.hypergeometric_law(good, bad, n)
    k = first + np.arange(len(law))
    p = good / (good + bad)
    mean = (law * k).sum()
    assert math.isclose(mean, n * p, rel_tol=1e-9)
    assert math.isclose((law * (k - mean) ** 2).sum(), n * p * (1 - p), rel_tol=1e-6)


def test_matrix_law():
    """Blocks of 2 and 2 rows into shards of 2 and 2: 1, 4, 1 of 6 ways."""
    seen = [int(sharding.communication_matrix([2, 2], 2, seed)[0, 0]) for seed in range(3000)]
    share = np.bincount(seen, minlength=3) / 3000
    assert np.allclose(share, [1 / 6, 4 / 6, 1 / 6], atol=0.03)


def test_matrix_sums_beyond_a_billion():
    sizes = [3 * 10**9 + i for i in range(5)]
    matrix = sharding.communication_matrix(sizes, 7, 1)
    assert matrix.sum(1).tolist() == sizes
    assert max(matrix.sum(0)) - min(matrix.sum(0)) <= 1 and (matrix >= 0).all()


def test_sample_is_bounded(spark):
    importable(spark)
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"text {i} {k} " + "x" * 100) for i in ids for k in range(3)] + [(None, "y")]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1)], "doc_id long, quality int")
    sample = quality.training_sample(docs, labels).collect()
    assert sorted(r.doc_id for r in sample) == ids  # one row of each id
    few = quality.training_sample(docs, labels, fit_rows=10).collect()
    assert len(few) == 10
    small = quality.training_sample(docs, labels, fit_bytes=1000).collect()
    assert 0 < len(small) and sum(len(r.text) for r in small) <= 1000


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect() if r.quality is not None}
    found = [r for r in quality.op10_quality(spark, sf).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in found)
    assert len(found) >= 50 and right / len(found) >= 0.95
