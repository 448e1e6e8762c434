"""The transducer against the tokenizers library: any block size, words that
go on over many blocks, and memory that does not grow with the text."""

import hashlib
import random
import tracemalloc
from itertools import chain

import numpy as np
import pytest

from eventide.llm import bpe, common, minhash


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_path())


def ids(encoder, text):
    return list(chain.from_iterable(encoder.encode(text)))


def expected(library, text):
    found = library.encode(text, add_special_tokens=False).ids
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(found), sha(",".join(map(str, found))), sha(library.decode(found, skip_special_tokens=False))


def texts(n):
    rng = random.Random(1)
    parts = ["a", "b", "é", "1", "2", " ", "  ", "\n", "\t", "'", "'s", "'re", ".", "!", "中", "word", "   \n  ", "😀",
             "<|endoftext|>", "ß"]
    return ["".join(rng.choice(parts) * rng.choice([1, 1, 1, 2, 3, 12, 40]) for _ in range(rng.randint(0, 25)))
            for _ in range(n)]


def test_blocks_of_any_size(library):
    whole, small = bpe.encoder_for(bpe.default_path()), bpe.Encoder(bpe.vocabulary(bpe.default_path()), block=7)
    for text in texts(600):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(whole, text) == want and ids(small, text) == want


def test_long_words(library):
    small = bpe.Encoder(bpe.vocabulary(bpe.default_path()), block=7)
    for text in ("ab" * 3000, "a" * 9000, "中文" * 1500, " " * 5000, "9" * 3333, "!?" * 2000, "x" + " " * 3000 + "y"):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(bpe.encoder_for(bpe.default_path()), text) == want and ids(small, text) == want


def test_batches(library):
    encoder = bpe.Encoder(bpe.vocabulary(bpe.default_path()))
    some = [*texts(60), "", "word " * 20_000, *texts(3), "a" * 200]
    found = dict(zip(encoder.batch_order(some), map(bpe.digests, encoder.batch(some)), strict=True))
    assert [found[k] for k in range(len(some))] == [expected(library, t) for t in some]


def test_memo_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 40)
    encoder = bpe.Encoder(bpe.vocabulary(bpe.default_path()))
    for text in texts(80):
        assert bpe.digests(encoder.words(text)) == expected(library, text)
    assert len(encoder.memo) + len(encoder.older) < 200


def test_one_word_takes_constant_memory():
    encoder = bpe.Encoder(bpe.vocabulary(bpe.default_path()))
    peaks = []
    for n in (20_000, 40_000):
        text = "abcdefghij" * n
        tracemalloc.start()
        bpe.digests(encoder.words(text))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] and peaks[1] < 8e6


def test_powers_do_not_stay():
    up, down = common.POWERS.upto(300_000)
    assert int(up[299_999]) == pow(common.BASE, 299_999, 1 << 64)
    assert int(up[77_777]) * int(down[77_777]) % (1 << 64) == 1
    assert len(common.POWERS.up) == len(common.POWERS.down) == common.KEPT_POWERS + 1


def test_short_texts_are_signed_in_bounded_memory():
    import pyarrow as pa

    n = 3000
    words = np.random.default_rng(1).integers(0, 5000, (n, 15))
    lines = [" ".join(f"w{w}" for w in row) for row in words]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array(range(n)), pa.array(lines)],
                                       ["doc_id", "__id", "__text", "text"])
    tracemalloc.start()
    assert sum(b.num_rows for b in minhash._sign(iter([batch]))) == n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6
