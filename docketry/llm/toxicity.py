"""Toxicity: subword-bag embeddings averaged into a linear softmax, in numpy.

A text's bag holds all its n-grams of 3 to 5 bytes, and those of 6 to 8 bytes that
begin at a word's edge, with A-Z lower-cased and no separator inside (one at either
end marks a word's edge).  They are hashed into a table of embeddings; the
average over the whole text, long or short, goes through a linear softmax of two
classes.  Unseen misspellings share n-grams, and thus vectors, with seen words.

Counts of n-grams by class are made in Spark; those that clearly lean to one class
(a likelihood ratio of ``LEAN`` standard errors, in ``LEAST`` texts or more) have
a vector, all others are zero.  Vectors and softmax are then trained
jointly on the bags of the sample, which hold nothing but bucket numbers and counts, so texts of
any length take part whole and never leave their tasks.

Null and empty texts have a defined score: that of an empty bag.  Repeated rows
score alike.  Labels other than 0 and 1, and null ids or labels, teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .labelled import fold, labelled_rows
from .shared import small_batches, tidy, written

SIZES, EDGE_SIZES = (3, 4, 5), (6, 7, 8)
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
DIM = 8
LEAN, LEAST = 5.0, 5
#: Occurrences of an n-gram in one text that count for its log odds.
MOST = 8
#: Neutral n-grams that join every bag, so that a bag of a few says little.
NEUTRAL = 64
#: Bytes of a text that are looked at together.
SLICE = 1 << 20
_LOOK_AHEAD = max(EDGE_SIZES)


@dataclass
class Model:
    """Embeddings (BUCKETS, DIM), softmax weights (DIM, 2) and biases (2)."""

    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def evidence(self) -> np.ndarray:
        """Each bucket's share in the difference of the two classes' logits."""
        return self.embeddings @ (self.weights[:, 1] - self.weights[:, 0]).astype(np.float32)


def _grams(data: np.ndarray, starts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size the places of n-grams, among the first ``starts`` bytes, and their buckets."""
    sep = ta._SEPARATOR[data]
    low = np.where(sep, np.uint8(32), ta._LOWER[data]).astype(np.uint32)
    at, h, solid = np.arange(min(starts, len(data))), np.zeros(min(starts, len(data)), np.uint32), np.ones(min(starts, len(data)), bool)
    for size in range(1, _LOOK_AHEAD + 1):
        if size == EDGE_SIZES[0]:
            edge = solid & sep[at]
            at, h, solid = at[edge], h[edge], solid[edge]
        last = at + size - 1
        inside = last < len(data)
        if not inside.all():
            at, h, solid, last = at[inside], h[inside], solid[inside], last[inside]
        h = h * np.uint32(0x01000193) + low[last] + np.uint32(1)
        if size > 2:
            solid = solid & ~sep[last - 1]
        if size in SIZES or size in EDGE_SIZES:
            x = (h[solid] ^ np.uint32(size)) * np.uint32(0x9E3779B1)
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x85EBCA77)
            yield at[solid], (x >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """Texts, each between two separators, in buffers: which text each part is of, where it starts, how many bytes begin n-grams, and the bytes."""
    owner, starts, held, size = [], [], [], 0
    for i, t in enumerate(texts):
        t = b" " + t + b" "
        if len(t) > SLICE:
            for k in range(0, len(t), SLICE):
                part = np.frombuffer(t[k : k + SLICE + _LOOK_AHEAD], np.uint8)
                yield np.array([i]), np.array([0]), SLICE, part
            continue
        if held and size + len(t) > SLICE:
            yield np.array(owner), np.array(starts), size, np.frombuffer(b"".join(held), np.uint8)
            owner, starts, held, size = [], [], [], 0
        owner.append(i)
        starts.append(size)
        held.append(t)
        size += len(t)
    if held:
        yield np.array(owner), np.array(starts), size, np.frombuffer(b"".join(held), np.uint8)


def _bags(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text and bucket of n-grams, some at a time; a text's may come in several turns."""
    for owner, starts, size, data in _pieces(texts):
        for at, bucket in _grams(data, size):
            yield owner[np.searchsorted(starts, at, "right") - 1], bucket


def probabilities(evidence: np.ndarray, bias: float, texts: list[bytes]) -> np.ndarray:
    """Toxicity of each text."""
    total, count = np.zeros(len(texts)), np.full(len(texts), float(NEUTRAL))
    for of, bucket in _bags(texts):
        total += np.bincount(of, weights=np.take(evidence, bucket), minlength=len(texts))
        count += np.bincount(of, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / count + bias, -30, 30)))


def _counted(sample: DataFrame) -> DataFrame:
    """Per bucket: occurrences and texts of class 0 and of class 1 in ``sample`` (text, label)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, BUCKETS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                buckets, n = np.unique(np.concatenate([b for _, b in _bags([text.encode()])]), return_counts=True)
                sums[label, buckets] += np.minimum(n, MOST)
                sums[2 + label, buckets] += 1
        found = np.flatnonzero(sums[2] + sums[3])
        for k in range(0, len(found), 8192):
            some = found[k : k + 8192]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(s[some]) for s in sums)], names=["bucket", "n0", "n1", "t0", "t1"])

    partial = sample.select("text", "label").mapInArrow(tidy(work), "bucket int, n0 long, n1 long, t0 long, t1 long")
    return partial.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "t0", "t1")))


def _likelihood_ratio(n0: int, n1: int) -> Column:
    """Twice the log of how much likelier the texts with an n-gram, t0 and t1 of n0 and n1, are by class than at one rate."""
    both = F.col("t0") + F.col("t1")
    out = F.lit(0.0)
    for t, n in (("t0", n0), ("t1", n1)):
        for seen, expected in ((F.col(t), both * n / (n0 + n1)), (n - F.col(t), (n0 + n1 - both) * n / (n0 + n1))):
            out = out + F.when((seen > 0) & (expected > 0), 2 * seen * F.log(seen / expected)).otherwise(0)
    return out


def train(sample: DataFrame, epochs: int = 20, batch: int = 64, seed: int = 5) -> Model:
    """Fit embeddings and softmax jointly by Adagrad to ``sample`` (doc_id, text, label).

    A vector's first dimension begins as its n-gram's log odds.  A sixth of the
    texts takes no part, and serves to scale the scores by.  With no rows, or
    rows of one class only, the model answers a constant.
    """
    rng = np.random.default_rng(seed)
    model = Model(np.zeros((BUCKETS, DIM), np.float32), rng.normal(0, 0.5, (DIM, 2)), np.zeros(2))
    small_batches(sample.sparkSession)
    sample = written(sample.withColumn("spare", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(6)) == 5), "toxicity-sample")
    texts = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(texts) < 2:
        model.bias[1] = 4.0 * (2 * next(iter(texts)) - 1) if texts else 0.0
        return model
    fit = sample.filter("not spare")
    sizes = {r.label: r.n for r in fit.groupBy("label").agg(F.count("*").alias("n")).collect()}
    odds = F.log((F.col("n1") + 0.5) / (sizes.get(1, 0) + 1)) - F.log((F.col("n0") + 0.5) / (sizes.get(0, 0) + 1))
    leaning = _counted(fit).withColumn("odds", odds).filter((F.col("t0") + F.col("t1") >= LEAST) & (_likelihood_ratio(sizes.get(0, 0), sizes.get(1, 0)) >= LEAN**2))
    known = leaning.select("bucket", "odds").orderBy("bucket").toArrow()  # BUCKETS rows at most
    names = known.column("bucket").to_numpy()
    vectors = rng.normal(0, 0.02, (len(names), DIM))
    vectors[:, 0] = known.column("odds").to_numpy()

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for text, label, spare in zip(*(some.column(c).to_pylist() for c in ("text", "label", "spare")), strict=True):
                found = np.concatenate([b for _, b in _bags([text.encode()])])
                place = np.minimum(np.searchsorted(names, found), max(0, len(names) - 1))
                place, n = np.unique(place[names[place] == found] if len(names) else place[:0], return_counts=True)
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([label], pa.int32()), pa.array([spare]), pa.array([len(found)], pa.int64()), pa.array([place.astype(np.int32)], kind), pa.array([n.astype(np.int32)], kind)], names=["label", "spare", "size", "place", "n"])

    held = sample.orderBy("doc_id").mapInArrow(tidy(bags), "label int, spare boolean, size long, place array<int>, n array<int>").toArrow()
    y, spare, size = (held.column(c).to_numpy() for c in ("label", "spare", "size"))
    place, n = ([np.asarray(x, np.int64) for x in held.column(c).to_pylist()] for c in ("place", "n"))

    def averages(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        of = np.repeat(np.arange(len(rows)), [len(place[r]) for r in rows])
        at = np.concatenate([np.zeros(0, np.int64), *(place[r] for r in rows)])
        share = np.concatenate([np.zeros(0), *(n[r] for r in rows)]) / (size[rows] + NEUTRAL)[of]
        h = np.stack([np.bincount(of, weights=share * vectors[at, d], minlength=len(rows)) for d in range(DIM)], 1)
        return h, of, at, share

    order = rng.permutation(np.flatnonzero(~spare))
    model.weights[0] = -8, 8
    model.bias[:] = 1, -1
    squares = [np.full_like(p, 1e-2) for p in (vectors, model.weights, model.bias)]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y).mean())
    for epoch in range(epochs):
        rate = 0.05 if epoch < epochs * 2 // 3 else 0.01
        for rows in np.array_split(rng.permutation(order), max(1, len(order) // batch)):
            h, of, at, share = averages(rows)
            logits = h @ model.weights + model.bias
            g = np.exp(logits - logits.max(1, keepdims=True))
            g /= g.sum(1, keepdims=True)
            g[np.arange(len(rows)), y[rows]] -= 1
            g *= weight[rows][:, None]
            gh = g @ model.weights.T
            gv = np.stack([np.bincount(at, weights=share * gh[of, d], minlength=len(vectors)) for d in range(DIM)], 1) + 1e-4 * vectors
            for value, square, grad in ((vectors, squares[0], gv), (model.weights, squares[1], h.T @ g), (model.bias, squares[2], g.sum(0))):
                square += grad**2
                value -= rate * grad / np.sqrt(square)
    model.embeddings[names] = vectors
    kept = np.flatnonzero(spare)
    if len(kept):
        logits = averages(kept)[0] @ model.weights + model.bias
        _scale(model, logits[:, 1] - logits[:, 0], y[kept])
    return model


def _scale(model: Model, z: np.ndarray, y: np.ndarray) -> None:
    """Stretch and move the logits so that ``z``, of texts that the model hasn't seen, are likeliest."""
    if y.min() == y.max():
        return
    spread = max(float(z.std()), 1e-9)
    a, b = 1.0, 0.0
    for _ in range(2000):
        g = (1 / (1 + np.exp(-np.clip(a * z / spread + b, -30, 30))) - y) / len(y)
        a, b = max(0.2, a - 2 * float((g * z / spread).sum())), b - 2 * float(g.sum())
    a /= spread
    move = a * float(model.bias[1] - model.bias[0]) + b
    model.weights *= a
    model.bias[:] = -move / 2, move / 2


def score(documents: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``documents`` with the probability of toxicity in ``into`` (replaced if there already)."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast((model.evidence(), float(model.bias[1] - model.bias[0])))  # a fixed 4 MB

    @F.arrow_udf("double")
    @tidy
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [np.zeros(0)]
            for _, _, data, offsets in ta.parts(texts):
                raw, o = data.tobytes(), offsets.tolist()
                found.append(probabilities(*shared.value, [raw[a:b] for a, b in zip(o, o[1:], strict=False)]))
            yield pa.array(np.concatenate(found), pa.float64())

    return documents.withColumn(into, probability(F.col(text).cast("string")))


def classify(documents: DataFrame, labels: DataFrame, rows_per_class: int = 1500, threshold: float = 0.7, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """Fit on the whole texts of at most ``rows_per_class`` labelled training rows of each class, score every whole text.

    Returns the documents with ``held_out``, ``score`` and ``predicted``, each replaced if there already.
    """
    scored = score(documents, train(labelled_rows(documents, labels, "toxic", modulus, held_out, rows_per_class, 5)))
    return scored.withColumns(
        {"held_out": F.coalesce(fold("doc_id", modulus) == held_out, F.lit(False)), "predicted": (F.col("score") >= threshold).cast("int")}
    )
