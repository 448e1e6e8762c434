"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of the whole text is encoded
(character classes, repetition, hashed words, then a learned layer), gated
attention weighs the passages (Ilse, Tomczak and Welling, "Attention-based
deep multiple instance learning", 2018), and the weighted sum is scored. Only
document labels are used. The model is fitted on a bounded sample of labelled
rows and applied to all documents in one map-only pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, mix, prefix_sums, POWERS, slices, strings, table, tidy

PASSAGE_WORDS = 50
#: Most labelled rows of the sample that the model is fitted on (parameter ``fit_rows``).
FIT_ROWS = 6000
#: Most bytes of text in the sample (parameter ``fit_bytes``).
FIT_BYTES = 64 << 20
#: Bytes of text encoded at once (its features take some thirty times as much).
SLICE = 1 << 19
THRESHOLD = 0.3
FOLDS = 5
SEED = 7

HASHED = 64
HIDDEN, GATE = 32, 16
EPOCHS, BAGS, RATE, DECAY = 30, 64, 0.01, 1e-4

#: Classes of bytes: blank, lower, upper, digit, beyond ASCII, then single marks, then any other.
MARKS = b"!#%&$*|.,-_/:;()\"'@+=<>?~^"


def _byte_classes() -> np.ndarray:
    out = np.full(256, 5 + len(MARKS), np.int64)
    out[[9, 10, 11, 12, 13, 32]] = 0
    out[ord("a"):ord("z") + 1], out[ord("A"):ord("Z") + 1] = 1, 2
    out[ord("0"):ord("9") + 1], out[128:] = 3, 4
    for i, b in enumerate(MARKS):
        out[b] = 5 + i
    return out


CLASS_OF = _byte_classes()
CLASSES = 6 + len(MARKS)
FEATURES = CLASSES + 7 + HASHED


def encode_passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage (runs of 50 words) and its text's number. A
    text without words has one passage of zeros."""
    raw = [t.encode() + b"\n" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    solid = np.diff(np.r_[False, CLASS_OF[data] > 0].astype(np.int8))
    starts, stops = np.flatnonzero(solid == 1), np.flatnonzero(solid == -1)
    doc = np.searchsorted(ends, starts, "right")
    first = np.searchsorted(doc, np.arange(len(texts)))
    nth = np.arange(len(starts)) - first[doc] if len(starts) else starts
    heads = np.flatnonzero(nth % PASSAGE_WORDS == 0)
    empty = np.setdiff1d(np.arange(len(texts)), doc)
    n = len(heads)
    out = np.zeros((n + len(empty), FEATURES), np.float32)
    owner = np.r_[doc[heads], empty].astype(np.int64)
    if n:
        passage = np.repeat(np.arange(n), np.diff(np.r_[heads, len(starts)]))
        # bytes belong to the passage of the last word that began before them
        cuts = starts[heads]
        of_byte = np.searchsorted(cuts, np.arange(cuts[0], len(data)), "right") - 1
        counts = np.bincount(of_byte * CLASSES + CLASS_OF[data[cuts[0]:]], minlength=n * CLASSES).reshape(n, CLASSES)
        words = np.bincount(passage, minlength=n).astype(np.float64)
        sizes = stops - starts
        sums = prefix_sums(data)
        _, down = POWERS.upto(len(data))
        hashes = mix((sums[stops] - sums[starts]) * down[starts] + sizes.astype(U64))
        again = np.r_[False, (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])]
        order = np.lexsort((hashes, passage))
        p, h = passage[order], hashes[order]
        new = np.r_[True, (p[1:] != p[:-1]) | (h[1:] != h[:-1])]
        distinct = np.bincount(p[new], minlength=n)
        upper = np.bincount(passage, CLASS_OF[data[starts]] == 2, minlength=n)
        lengths = np.bincount(passage, sizes, minlength=n)
        marked = CLASS_OF[data[stops - 1]] >= 5
        ended = np.bincount(passage, marked, minlength=n)
        bags = np.bincount(passage * HASHED + (hashes % U64(HASHED)).astype(np.int64),
                           minlength=n * HASHED).reshape(n, HASHED)
        out[:n] = np.column_stack([
            np.sqrt(counts / counts.sum(1, keepdims=True)), words / PASSAGE_WORDS, lengths / words / 10,
            np.bincount(passage, again, minlength=n) / words, distinct / words, upper / words, ended / words,
            np.log1p(np.maximum.reduceat(sizes, heads)) / 5, np.sqrt(bags / words[:, None])])
    order = np.argsort(owner, kind="stable")
    return out[order], owner[order]


@dataclass
class Model:
    """Parameters: layer (w, b), gates (v, u), attention a, score (c, d)."""

    mean: np.ndarray
    scale: np.ndarray
    par: dict[str, np.ndarray]

    @classmethod
    def new(cls, features: np.ndarray, seed: int = SEED) -> Model:
        draw = np.random.default_rng(seed)
        normal = lambda *s: draw.normal(0, 1 / np.sqrt(s[0]), s)
        mean = features.mean(0, dtype=np.float64) if len(features) else np.zeros(FEATURES)
        scale = features.std(0, dtype=np.float64) + 1e-3 if len(features) else np.ones(FEATURES)
        return cls(mean, scale, {
            "w": normal(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "v": normal(HIDDEN, GATE), "u": normal(HIDDEN, GATE),
            "a": normal(GATE), "c": np.zeros(HIDDEN), "d": np.zeros(1)})

    def forward(self, features: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple:
        """Bags lie end to end; returns the score of each and what the
        gradient needs."""
        p = self.par
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (t * g) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        weight = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(weight[:, None] * h, starts)
        return _sigmoid(z @ p["c"] + p["d"]), (x, h, t, g, weight, z)

    def gradient(self, starts, sizes, score, label, state) -> dict[str, np.ndarray]:
        p, (x, h, t, g, weight, z) = self.par, state
        out = (score - label) / len(label)
        dz = np.repeat(out[:, None] * p["c"], sizes, axis=0)
        dweight = (dz * h).sum(1)
        de = weight * (dweight - np.repeat(np.add.reduceat(weight * dweight, starts), sizes))
        dt, dg = de[:, None] * p["a"] * g * (1 - t * t), de[:, None] * p["a"] * t * g * (1 - g)
        dh = (weight[:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - h * h)
        return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de,
                "c": z.T @ out, "d": out.sum(keepdims=True)}

    def score(self, features: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        starts = np.searchsorted(owner, np.arange(n))
        return self.forward(features, starts, np.diff(np.r_[starts, len(owner)]))[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = SEED, epochs: int = EPOCHS) -> Model:
    """Cross-entropy by Adam over shuffled groups of bags."""
    model = Model.new(np.concatenate(bags) if bags else np.zeros((0, FEATURES)), seed)
    if not bags:
        return model
    rate = np.clip(labels.mean(), 0.01, 0.99)
    model.par["d"][:] = np.log(rate / (1 - rate))
    draw, step = np.random.default_rng(seed), 0
    first, second = ({k: np.zeros_like(v) for k, v in model.par.items()} for _ in range(2))
    sizes = np.array([len(b) for b in bags])
    for _ in range(epochs):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), BAGS):
            own = order[at:at + BAGS]
            n = sizes[own]
            starts = np.cumsum(n) - n
            score, state = model.forward(np.concatenate([bags[i] for i in own]), starts, n)
            step += 1
            for k, grad in model.gradient(starts, n, score, labels[own], state).items():
                grad = grad + DECAY * model.par[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                model.par[k] = model.par[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0 (a
    null id counts as the empty text, hence held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_sample(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> DataFrame:
    """text and quality of at most ``fit_rows`` labelled documents outside
    the held-out fold, the first by a hash of their id, as long as their texts
    have ``fit_bytes`` in all. An id with several labels counts as 1 if any is;
    one on several rows gives one of its texts. The labels are joined as a
    broadcast: their number is bounded by the sample."""
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        .withColumnsRenamed({"doc_id": "__id", "label": "__label"}))
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select(
        F.col("__id").alias("doc_id"), F.col("__label").alias("label"), F.col("text"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), F.octet_length(F.coalesce("text", F.lit(""))).alias("size"))
    # one text of each id; a window over at most fit_rows rows adds up their bytes
    one = found.groupBy("doc_id").agg(F.min("hash").alias("hash"), F.max("size").alias("size"))
    in_order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fits = one.withColumn("bytes", F.sum("size").over(in_order)).filter(F.col("bytes") <= fit_bytes).select("doc_id", "hash")
    return found.join(F.broadcast(fits), ["doc_id", "hash"]).dropDuplicates(["doc_id"]).select("doc_id", "label", "text")


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", SLICE):
            features, owner = encode_passages(strings(batch, "text"))
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            blobs = [features[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())],
                                             ["doc_id", "label", "features"])


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> Model:
    """Fit on the driver from the sample's passage features (bounded by
    ``fit_rows`` documents of ``fit_bytes``)."""
    sample = training_sample(docs, labels, fit_rows, fit_bytes).mapInArrow(
        tidy(_bags), "doc_id long, label double, features binary").collect()
    sample.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    bags = [np.frombuffer(r["features"], np.float32).reshape(-1, FEATURES) for r in sample]
    return fit(bags, np.array([r["label"] for r in sample], np.float64))


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with the score of each row's text in column ``name``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                features, owner = encode_passages(strings(batch, "text"))
                score = model.score(features, owner, batch.num_rows)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())],
                                                 [*batch.schema.names, name])

    return docs.mapInArrow(tidy(run), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    A null or empty text is scored as one passage of zeros. Repeated rows get
    equal scores; without labels every score is 0.5. An empty table gives no
    rows. Only doc_id and text are read, and only text is scored."""
    model = train(docs, labels, fit_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_score(rows, model, "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows that the classifier does not reject, all columns (which may
    have any names)."""
    name = "score"
    while name in docs.columns:
        name += "_"
    return with_score(docs, train(docs, labels, fit_rows), name).filter(F.col(name) >= THRESHOLD).select(*docs.columns)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
