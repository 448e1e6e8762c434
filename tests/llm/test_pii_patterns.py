"""Added spans: planted unseen identifiers are found through patterns, decoys
are not, chains of patterns are followed to their end, long texts stay cheap."""

import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from eventide.llm import pii  # noqa: E402
from eventide.llm.common import importable  # noqa: E402


def spans(spark, texts):
    importable(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [tuple(s.split(":")) for s in r.spans.split(",") if s] for r in pii.find_pii(docs).collect()}


def added(texts, found, doc):
    base = {(k, str(a), str(b)) for k, own in brute.base_pii(texts[doc]).items() for a, b in own}
    return {(k, texts[doc][int(a):int(b)]) for k, a, b in set(found[doc]) - base}


def test_unseen_identifiers_and_decoys(spark):
    seeds = [f"please write to user{i}@host{i}.org today" for i in range(100)]
    unseen = [f"please write to user{i}[at]host today" for i in range(100, 120)]  # a sixth of what stands there
    decoys = [f"released as version {i}.{i + 1} under terms" for i in range(20)] + [f"the year 19{i:02d} was cold" for i in range(20)]
    texts = seeds + unseen + decoys
    found = spans(spark, texts)
    hits = [added(texts, found, d) for d in range(len(texts))]
    recall = sum(("email", f"user{i}") in hits[100 + k] for k, i in enumerate(range(100, 120))) / 20
    wrong = sum(len(h) for h in hits[100 + 20:]) + sum(len(h) for h in hits[:100])
    assert recall == 1.0 and wrong == 0


def test_chains_of_patterns_run_to_their_end(spark):
    """Seeds teach one pattern, the units found there teach the next, and so on."""
    steps, texts, known = ["alpha", "beta", "gamma", "delta"], [], [f"a{i}@b{i}.org" for i in range(1500)]
    for k, step in enumerate(steps):
        new = [f"id{k}x{i}" for i in range(len(known) // 5)]
        texts += [f"deep {step} {unit} stop{k}" for unit in known + new]
        known = new
    found = spans(spark, texts)
    last = [added(texts, found, len(texts) - 1 - i) for i in range(len(known))]
    assert len(known) == 2 and all(h == {("email", u)} for h, u in zip(last, reversed(known), strict=True))


def test_secrets(spark):
    key = "04dbebab91ab85687d33ee0f1f2d3c4b5a697887"
    texts = [f'set token = "{key[i:] + key[:i]}" now' for i in range(10)] + [
        'set token = "77short1" now', "a" * 40, "1" * 40, f"commit {key}"]
    found = spans(spark, texts)
    assert all(added(texts, found, d) == {("secret", key[d:] + key[:d])} for d in range(10))
    assert added(texts, found, 10) == {("secret", "77short1")}
    assert not added(texts, found, 11) and not added(texts, found, 12) and added(texts, found, 13) == {("secret", key)}


@pytest.mark.parametrize("n", [10_000, 40_000])
def test_long_texts_of_units(spark, n):
    text = " ".join(f"id{i} x" for i in range(n))
    spans(spark, ["warm 1"])
    begun = time.time()
    found = spans(spark, [text, None, "", "mail a@b.co"])
    assert time.time() - begun < 30
    assert found[0] == [] and found[1] == [] and found[3] == [("email", "5", "11")]


def test_places(spark):
    from pyspark.sql import functions as F

    for n in (0, 1, 31, 32, 33, 1025, 33_000):
        text = "é" + "".join(f"{i}aé" for i in range(n))
        df = spark.createDataFrame([(text,)], "text string")
        got = df.select(pii.placed(F.col("text"), "[0-9]+", F.lit(True)).alias("m")).first()["m"]
        import re
        assert [(m["start"], m["end"], m["word"]) for m in got] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text)]
