"""Kept rows of the pipeline's stages, and of all of them in a row, against brute force."""

import os
import random
import re
import sys
from collections import defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from eventide.llm import quality  # noqa: E402
from eventide.llm.common import importable, table  # noqa: E402

NO_ID = 1 << 62  # a null id comes last


def fixture_rows():
    draw = random.Random(11)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(3, 8))) for _ in range(500)]
    text = lambda n: " ".join(draw.choices(words, k=n))
    rows = [(k, text(120)) for k in range(40)]
    for k in range(6):  # copies, one longer by blanks; near copies; a null id among both
        rows += [(100 + k, rows[k][1]), (110 + k, rows[k + 6][1] + "  "), (120 + k, rows[k + 12][1] + " tail")]
    rows += [(None, rows[20][1]), (None, rows[21][1] + " tail"), (None, text(80)), (200, None), (201, ""), (202, None)]
    rows += [rows[2], rows[30], rows[30], rows[-4]]  # repeated rows, with and without id
    passage = " ".join(rows[33][1].split()[20:40])
    return rows, [(None, passage), (5, " ".join(rows[35][1].split()[:12]))]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rows, items = fixture_rows()
    folder = str(tmp_path_factory.mktemp("pipeline"))
    importable(spark)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(k, k % 4 and 1) for k in range(40)], "doc_id long, quality int").write.parquet(
        f"{folder}/labels.parquet")
    return folder, rows, items


def key(row):
    return (row[0] if row[0] is not None else NO_ID, row[1] or "")


def exact(rows):
    groups = defaultdict(list)
    for d, t in map(key, rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), d, t))
    return sorted((d, t) for _, d, t in map(min, groups.values()))


def near(rows):
    single = sorted(set(map(key, rows)))  # repeated rows count once
    classes = brute.near_classes([(k, t) for k, (_, t) in enumerate(single)])
    return [single[k] for k in sorted(set(classes.values()))]


def clean(rows, items):
    found = brute.contaminated([(k, t) for k, (_, t) in enumerate(rows)], items)
    return sorted(key(rows[k]) for k, *_, hit in found if not hit)


def good(folder, spark, rows):
    model = quality.train(table(spark, folder, "documents"), table(spark, folder, "labels"))
    out = []
    for row in rows:
        features, owner = quality.encode_passages([row[1] or ""])
        if model.score(features, np.asarray(owner), 1)[0] >= quality.THRESHOLD:
            out.append(key(row))
    return sorted(out)


def kept(df):
    return sorted(key((r.doc_id, r.text)) for r in df.collect())


def test_stages_and_run(spark, data):
    folder, rows, items = data
    docs = table(spark, folder, "documents")
    left = good(folder, spark, rows)
    stages = [(corpus_pipeline.quality_stage, left), (corpus_pipeline.exact_stage, exact(rows)),
              (corpus_pipeline.near_stage, near(rows)), (corpus_pipeline.benchmark_stage, clean(rows, items))]
    wrong = {}
    for stage, want in stages:
        got = kept(stage(spark, docs, folder))
        if got != want:
            wrong[stage.__name__] = [(d, t[:30]) for d, t in set(got) ^ set(want)] or (len(got), len(want))
    assert not wrong, wrong
    want = clean(near(exact(left)), items)
    assert sorted(r.doc_id if r.doc_id is not None else NO_ID for r in corpus_pipeline.run(spark, folder).collect()) == [
        d for d, _ in want]
