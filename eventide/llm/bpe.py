"""BPE encoding by a bounded-lookahead streaming transducer, and decoding by
an incremental byte-to-text state machine.

Whether a merge ever joins two neighbouring bytes depends on the text to the
right only through a chain of merges of falling rank, each of which takes a
symbol that ends the right part of the one before (Berglund and van der
Merwe, "Formalizing BPE tokenization", 2023). The longest such chain of the
merge list is its sufficient lookahead: once so many bytes behind a token
boundary are known, nothing that follows can move it. The transducer holds
that many bytes and a block, whatever the length of the input or of a word in it:
a pre-token that does not end within a block goes on in pieces.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_tables import Vocabulary, default_path, vocabulary
from .common import slices, strings, table, tidy, worker_cache

#: Characters of a text taken in at once, and bytes of a pre-token beyond the lookahead.
BLOCK = 1 << 16
#: A pre-token's last characters can change its split: a contraction has up to
#: three, and a run of blanks gives its last one to the word behind it.
SPLIT_LOOKAHEAD = 3
#: Pre-tokens remembered by a worker (and those of one batch more), in two halves of
#: which the older goes when the newer is full; longer ones are not remembered.
MEMO = 160_000
MEMO_WORD = 64

#: What carries on a pre-token that has reached the end of a block, by the kind of its last character.
RUNS = [regex.compile(r"\p{L}*"), regex.compile(r"\p{N}*"), regex.compile(r"\s*"), regex.compile(r"[^\s\p{L}\p{N}]*")]
SPACES = RUNS[2]


def lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Sufficient lookahead in bytes. The application of merge (u, v) at a
    place hangs on |v| bytes right of u, and on any earlier merge (u', v')
    whose u' is a suffix of v, which hangs on the bytes right of u' in turn."""
    reach: dict[bytes, int] = {}
    most = 0
    for u, v in merges:
        own = len(v) + max((reach.get(v[i:], 0) for i in range(len(v))), default=0)
        reach[u] = max(reach.get(u, 0), own)
        most = max(most, own)
    return most


#: A pre-token's number of tokens, their ids as comma-joined text, and the bytes that these decode to.
Word = tuple[int, bytes, bytes]


class Pieces:
    """A byte string by token id, laid end to end, to be joined for many tokens at once."""

    def __init__(self, of: dict[int, bytes]) -> None:
        listed = [of.get(i, b"") for i in range(max(of) + 1)]
        self.data = np.frombuffer(b"".join(listed), np.uint8)
        self.sizes = np.array([len(x) for x in listed], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def joined(self, tokens: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The tokens' strings end to end, and where each begins (and the last ends)."""
        sizes = self.sizes[tokens]
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(cuts[-1]) + np.repeat(self.begins[tokens] - cuts[:-1], sizes)
        return self.data[at].tobytes(), cuts


class Encoder:
    NONE = 1 << 62

    def __init__(self, vocab: Vocabulary, block: int = BLOCK) -> None:
        self.vocab, self.block = vocab, block
        # a pair of symbols in one number -> its rank and what it makes in one number, so the smallest is the next merge
        self.pairs = {a << 20 | b: r << 20 | ab for r, (a, b, ab) in enumerate(vocab.merges)}
        self.lookahead = lookahead([(vocab.bytes_of[a], vocab.bytes_of[b]) for a, b, _ in vocab.merges])
        keys = np.array([a << 20 | b for a, b, _ in vocab.merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.made = np.array([ab for _, _, ab in vocab.merges], np.int64)
        self.byte_ids = np.array(vocab.byte_ids, np.int64)
        self.names = Pieces({i: f"{i},".encode() for i in vocab.bytes_of})
        self.raw = Pieces(vocab.bytes_of)
        self.memo: dict[str, Word] = {}
        self.older: dict[str, Word] = {}

    def _tokens(self, ids: list[int]) -> Word:
        return (len(ids), ",".join(map(str, ids)).encode(), b"".join(map(self.vocab.bytes_of.__getitem__, ids)))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols."""
        pair = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], self.NONE)

    def learn(self, words: list[str]) -> None:
        """Remember the tokens of short words: all are merged side by side, each
        at every place of its own next merge."""
        if not words:
            return
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols, own = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)], np.arange(len(raw))
        rank = np.append(self._ranks(symbols[:-1], symbols[1:]), self.NONE)
        rank[np.cumsum(sizes) - 1] = self.NONE  # a word's last symbol begins no pair
        while len(own):
            ends = np.cumsum(sizes)
            lowest = np.minimum.reduceat(rank, ends - sizes)
            done = lowest == self.NONE
            left = np.repeat(~done, sizes)
            self._remember([words[i] for i in own[done].tolist()], symbols[~left], sizes[done])
            here = np.flatnonzero((rank == np.repeat(lowest, sizes)) & left)
            # merges do not overlap: of places side by side, every second one from the left
            first = np.r_[True, np.diff(here) > 1][:len(here)]
            run = np.maximum.accumulate(np.where(first, np.arange(len(here)), 0))
            here = here[(np.arange(len(here)) - run) % 2 == 0]
            symbols[here] = self.made[rank[here]]
            left[here + 1] = False
            sizes = (sizes - np.bincount(np.searchsorted(ends, here, "right"), minlength=len(sizes)))[~done]
            here = (np.cumsum(left) - 1)[here]
            symbols, rank, own = symbols[left], rank[left], own[~done]
            # only pairs with a new symbol have another rank than before
            if len(here):
                begins = np.zeros(len(symbols) + 1, bool)
                begins[np.cumsum(sizes) - sizes] = begins[-1] = True
                pairs = np.concatenate([here[~begins[here + 1]], here[~begins[here]] - 1])
                rank[here] = self.NONE
                rank[pairs] = self._ranks(symbols[pairs], symbols[pairs + 1])

    def _remember(self, words: list[str], tokens: np.ndarray, sizes: np.ndarray) -> None:
        cuts = np.cumsum(np.r_[0, sizes])
        (names, at), (raw, of) = self.names.joined(tokens), self.raw.joined(tokens)
        at, of = at[cuts].tolist(), of[cuts].tolist()
        for k, (w, n) in enumerate(zip(words, sizes.tolist(), strict=True)):
            self.memo[w] = (n, names[at[k]:at[k + 1] - 1], raw[of[k]:of[k + 1]])

    def _merge(self, raw: bytes) -> list[int]:
        """Tokens of a bounded run of bytes, by a heap of pairs over linked symbols."""
        ids = [self.vocab.byte_ids[b] for b in raw]
        get, n = self.pairs.get, len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(code, i) for i in range(n - 1) if (code := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            code, i = heappop(heap)
            j = after[i]
            if not alive[i] or j == n or get(ids[i] << 20 | ids[j]) != code:
                continue  # one of the two symbols has changed since
            ids[i], alive[j], after[i] = code & 0xFFFFF, False, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (new := get(ids[i] << 20 | ids[after[j]])) is not None:
                    heappush(heap, (new, i))
            h = before[i]
            if h >= 0 and (new := get(ids[h] << 20 | ids[i])) is not None:
                heappush(heap, (new, h))
        return [t for t, ok in zip(ids, alive, strict=True) if ok]

    def stable(self, chunks: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of one pre-token that arrives in chunks. A token goes out
        once the lookahead behind its end is in; what is held stays below
        eight times the lookahead + longest token + chunk."""
        held = b""
        for chunk in chunks:
            held += chunk
            if len(held) <= 8 * self.lookahead:
                continue
            ids, end, out = self._merge(held), 0, []
            for i in ids:
                if end + len(self.vocab.bytes_of[i]) + self.lookahead > len(held):
                    break
                end += len(self.vocab.bytes_of[i])
                out.append(i)
            held = held[end:]
            yield out
        yield self._merge(held)

    def pretokens(self, text: str) -> Iterator[str | Iterator[str]]:
        """The pattern's matches, read block by block: a match goes out once
        no further text can change it, the rest begins the next block. A match
        that does not end within a block is given as an iterator of its pieces,
        to be read before the next match."""
        if len(text) <= self.block:
            yield from self.vocab.pattern.findall(text)
            return
        at = 0
        while at < len(text):
            part, moved = text[at:at + self.block], 0
            last = at + len(part) == len(text)
            for m in self.vocab.pattern.finditer(part):
                if not last and m.end() > len(part) - SPLIT_LOOKAHEAD:
                    break
                yield m[0]
                moved = m.end()
            if not moved and not last:
                moved = self._length(text, at)
                yield (text[k:min(k + self.block, at + moved)] for k in range(at, at + moved, self.block))
            at += moved
            if last:
                return

    def _length(self, text: str, at: int) -> int:
        """Characters of the match at ``at``, which fills a block: its run of
        one kind is followed block by block."""
        end = at + self.vocab.pattern.match(text[at:at + self.block]).end()
        run = next(r for r in RUNS if r.fullmatch(text[end - 1]))
        while end < len(text):
            more = run.match(text[end:end + self.block]).end()
            end += more
            if not more:
                break
        if run is SPACES:
            end -= end < len(text)  # a run of blanks leaves its last one to what follows
        return end - at

    def _long(self, word: str | Iterator[str]) -> Iterator[Word]:
        """A long pre-token, as its tokens become stable."""
        pieces = [word] if isinstance(word, str) else word
        raw = (piece[k:k + self.lookahead].encode() for piece in pieces for k in range(0, len(piece), self.lookahead))
        return (self._tokens(ids) for ids in self.stable(raw) if ids)

    def _known(self, group: list[str | Iterator[str]]) -> Iterable[Word]:
        """Tokens of pre-tokens of which the short ones are remembered."""
        memo, older = self.memo.get, self.older.get
        found = [memo(w) or older(w) for w in group]
        if None not in found:
            return found
        return chain.from_iterable(self._long(w) if f is None else (f,) for w, f in zip(group, found, strict=True))

    def _grouped(self, text: str) -> Iterator[list]:
        """The pre-tokens of a text in groups of a block's length, the last of
        which may be one that goes on in pieces; special tokens are ids."""
        for special, piece in self.vocab.pieces(text):
            if special is not None:
                yield [special]
                continue
            if len(piece) <= self.block:
                yield self.vocab.pattern.findall(piece)
                continue
            group, size = [], 0
            for w in self.pretokens(piece):
                group.append(w)
                size += len(w) if isinstance(w, str) else self.block
                if size >= self.block:
                    yield group
                    group, size = [], 0
            if group:
                yield group

    def _unknown(self, group: list) -> set[str]:
        new = set(group).difference(self.memo).difference(self.older)
        return {w for w in new if isinstance(w, str) and len(w) <= MEMO_WORD}

    def _make_room(self) -> None:
        if len(self.memo) >= MEMO // 2:
            self.older, self.memo = self.memo, {}

    def words(self, text: str) -> Iterator[Word]:
        """The tokens, by pre-token, special token or stable piece of a long pre-token."""
        for group in self._grouped(text):
            if isinstance(group[0], int):
                yield self._tokens(group)
            else:
                self._make_room()
                self.learn(list(self._unknown(group)))
                yield from self._known(group)

    def batch(self, texts: list[str]) -> Iterator[Iterator[Word]]:
        """``words`` of each text. Those of at most a block each share one
        round of learning, so ``texts`` should be few megabytes together."""
        split = {k: [group for group in self._grouped(t)] for k, t in enumerate(texts) if len(t) <= self.block}
        self._make_room()
        self.learn(list(set().union(*(self._unknown(g) for groups in split.values() for g in groups))))
        for k, t in enumerate(texts):
            if k in split:
                yield chain.from_iterable(
                    [self._tokens(g)] if isinstance(g[0], int) else self._known(g) for g in split[k])
        # long texts last, as they may push words out of the memo
        for k, t in enumerate(texts):
            if k not in split:
                yield self.words(t)

    def batch_order(self, texts: list[str]) -> list[int]:
        """The texts' numbers in the order of ``batch``."""
        return sorted(range(len(texts)), key=lambda k: len(texts[k]) > self.block)

    def encode(self, text: str) -> Iterator[tuple[int, ...]]:
        """Token ids, a tuple for each of ``words``."""
        return (tuple(map(int, ids.split(b","))) for _, ids, _ in self.words(text))


def decode(ids: Iterable[int], bytes_of: dict[int, bytes]) -> Iterator[str]:
    """Text pieces as soon as they are complete: a state machine over the
    token bytes that holds at most the first bytes of one character; bytes
    that are no UTF-8 give U+FFFD, and unknown ids nothing."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        yield machine.decode(bytes_of.get(i, b""))
    yield machine.decode(b"", final=True)


#: Words whose ids and bytes are joined at once.
STEP = 256


def digests(words: Iterator[Word]) -> tuple[int, str, str]:
    """Tokens, digest of the ids and digest of the decoded text, from streams
    of ids and of decoded text."""
    ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    while held := list(islice(words, STEP)):
        tokens, text, raw = zip(*held, strict=True)
        ids_hash.update((b"," if n else b"") + b",".join(text))
        text_hash.update(machine.decode(b"".join(raw)).encode())
        n += sum(tokens)
    text_hash.update(machine.decode(b"", final=True).encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def encoder_for(path: str) -> Encoder:
    """The worker's encoder of a vocabulary."""
    kept = worker_cache("bpe")
    if path not in kept:
        kept[path] = Encoder(vocabulary(path))
    return kept[path]


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with a column ``token_ids`` (array of int) added."""
    path = path or default_path()
    if "token_ids" in docs.columns:
        raise ValueError("docs already has a column token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                ids = [list(chain.from_iterable(encoder.encode(t))) for t in strings(batch, "text")]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))],
                                                 [*batch.schema.names, "token_ids"])

    from pyspark.sql import types as T

    return docs.mapInArrow(tidy(run, "bpe"), T.StructType([*docs.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType()))]))


def decode_documents(docs: DataFrame, path: str | None = None, ids: str = "token_ids", to: str = "text") -> DataFrame:
    """``docs`` with the text of the array column ``ids`` in column ``to``
    (null for a null array)."""
    path = path or default_path()

    @F.pandas_udf("string")
    def text(column):
        bytes_of = encoder_for(path).vocab.bytes_of
        return column.map(lambda x: None if x is None else "".join(decode(x.tolist(), bytes_of)))

    return docs.withColumn(to, text(ids))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, in one
    map-only pass. A null or empty text has no ids and an empty decoded text.
    Repeated rows are encoded each; an empty table gives no rows; only doc_id
    and text are read."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                texts = strings(batch, "text")
                found = dict(zip(encoder.batch_order(texts), map(digests, encoder.batch(texts)), strict=True))
                n, ids, text = zip(*(found[k] for k in range(len(texts))), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tidy(run, "bpe"), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
