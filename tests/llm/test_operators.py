"""Every operator against its brute-force version, on a small table with
nulls, empty texts, repeated rows, copies and a clashing extra column."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from eventide.llm import bpe, decontam, exact_dedup, minhash, pii, quality, sharding, suffix, tokens  # noqa: E402
from eventide.llm.common import importable, table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    importable(spark)
    found = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    long = "word " * 9000 + found[0][1]
    return found[:60] + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a" * 3000), (1004, found[3][1]),
                         (1005, found[3][1] + " "), (1006, long), (1007, "x <|endoftext|> y"),
                         (1008, "mail a.b@c.de, +1 (375) 555-4393, 1.2.3.4.5, 4111 1111 1111 1111 é 😀")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, digest string")


def got(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_suffix(docs, rows):
    assert got(suffix.remove_repeats(docs, 60).drop("removed")) == sorted(brute.repeats(rows, 60))


def test_near(docs, rows):
    assert dict(got(minhash.near_duplicates(docs), "doc_id", "class_id")) == brute.near_classes(rows)


def test_exact(docs, rows):
    assert got(exact_dedup.exact_dedup(docs).select(exact_dedup.COLUMNS)) == sorted(brute.copies(rows))


def test_decontamination(spark, docs, rows):
    items = [(1, rows[5][1][:300]), (2, rows[9][1][40:90]), (3, None), (4, ""), (1, rows[7][1][:200])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute.contaminated(rows, [i for i in items if i[1]]))
    assert got(decontam.decontaminate(docs, bench)) == want
    assert got(decontam.decontaminate(docs, bench, block_words=20)) == want


def test_tokens_and_bpe(docs, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    ids = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in rows}
    assert got(tokens.count_tokens(docs), "doc_id", "n_tokens") == sorted((d, len(i)) for d, i in ids.items())
    assert got(bpe.round_trip(docs)) == sorted(
        (d, len(i), brute.sha(",".join(map(str, i))), brute.sha(library.decode(i, skip_special_tokens=False)))
        for d, i in ids.items())


def test_streaming_encoder_is_block_independent(rows):
    whole, small = bpe.encoder_for(bpe.default_path()), bpe.Encoder(bpe.vocabulary(bpe.default_path()), block=7)
    for _, text in rows[:20]:
        assert [i for t in whole.encode(text) for i in t] == [i for t in small.encode(text) for i in t]
    run = b"ab" * 3000
    stream = [i for part in whole.stable(run[k:k + 100] for k in range(0, len(run), 100)) for i in part]
    assert stream == whole._merge(run)


def test_pii(docs, rows):
    want = {d: brute.base_pii(t) for d, t in rows}
    for r in pii.find_pii(docs).collect():
        spans = [f"{k}:{a}:{b}" for k in brute.PII for a, b in want[r.doc_id][k]]
        assert r.base_sha256 == brute.sha(",".join(spans))
        assert set(spans) <= set(r.spans.split(",")) | {""}


def test_shards(docs, rows):
    found = sharding.shard_rows(docs, shards=7).collect()
    sizes = [sum(r.shard == k for r in found) for k in range(7)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in found if r.shard == k) == list(range(n)) for k, n in enumerate(sizes))
    matrix = sharding.communication_matrix([5, 0, 9], 4, 1)
    assert matrix.sum(1).tolist() == [5, 0, 9] and matrix.sum(0).tolist() == [4, 4, 3, 3]


def test_quality(spark, docs):
    found = quality.quality_scores(docs, table(spark, SF, "labels")).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)


def test_empty(spark, docs):
    none = docs.limit(0)
    labels = table(spark, SF, "labels").limit(0)
    for df in (exact_dedup.exact_dedup(none), minhash.near_duplicates(none), suffix.remove_repeats(none),
               pii.find_pii(none), sharding.shard_rows(none), tokens.count_tokens(none), bpe.round_trip(none),
               quality.quality_scores(none, labels), decontam.decontaminate(none, table(spark, SF, "benchmark"))):
        assert df.count() == 0
