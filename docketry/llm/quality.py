"""Quality classifier: a byte-level convolutional network in numpy.

Narrow learned filters of five bytes slide over every position.  Their rectified
responses are max-pooled over the whole document.  Wide learned filters look at
overlapping chunks of 128 bytes in steps of 64, the last of them up to the text's end:
each weighs the narrow filters' mean responses within the chunk, is
rectified, and is max-pooled over all chunks too.  So a wide filter is a convolution over
132 bytes, whose kernel is put together from the narrow ones; it sees what
a chunk is made of, such as a few words over and over.  A logistic layer combines
all pooled values into one probability.  All weights are learned together.

Null and empty texts have a defined score: that of a single zero byte.  Repeated
rows score alike, but for rounding.  Labels other than 0 and 1, and null ids or labels, teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .labelled import fold, labelled_rows
from .shared import small_batches, tidy

WIDTH = 5
NARROW, WIDE = 8, 24
CHUNK, STEP = 128, 64
#: Bytes of a text that are looked at together; a multiple of STEP.
SLICE = 1 << 17


@dataclass
class Network:
    """Narrow filters (WIDTH, 256, NARROW), wide filters (NARROW, WIDE), biases, and the combining layer."""

    filters: np.ndarray
    bias: np.ndarray
    wide: np.ndarray
    wide_bias: np.ndarray
    combine: np.ndarray
    offset: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        def normal(scale: float, *shape: int) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return cls(normal(0.3, WIDTH, 256, NARROW), normal(0.1, NARROW), normal(1.0, NARROW, WIDE), normal(0.1, WIDE), normal(0.1, NARROW + WIDE), np.zeros(1, np.float32))


@dataclass
class Views:
    """Where pieces of texts lie in one buffer, each in blocks of STEP bytes of its own: starts, lengths, blocks and chunks."""

    buffer: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    first: np.ndarray  # block of each piece, and one past the last
    chunk: np.ndarray  # first block of each chunk
    first_chunk: np.ndarray
    ends: np.ndarray  # of chunks

    @classmethod
    def of(cls, pieces: list[tuple[bytes, bytes]]) -> Views:
        """Of pieces, each with the bytes that follow it in its text."""
        pieces = [(p or b"\0", after[: WIDTH - 1].ljust(WIDTH - 1, b"\0")) for p, after in pieces]
        lengths = np.array([len(p) for p, _ in pieces], np.int64)
        blocks = -(-(lengths + WIDTH - 1) // STEP)
        first = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
        buffer = np.frombuffer(b"".join((p + after).ljust(n * STEP, b"\0") for (p, after), n in zip(pieces, blocks.tolist(), strict=True)) + b"\0" * (WIDTH - 1), np.uint8)
        starts = first[:-1] * STEP
        # chunks of two blocks; the last one reaches to the text's end
        count = np.maximum(1, -(-lengths // STEP) - 1)
        first_chunk = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        of = np.repeat(np.arange(len(pieces)), count)
        chunk = first[of] + np.arange(first_chunk[-1]) - first_chunk[of]
        return cls(buffer.astype(np.intp), starts, lengths, first, chunk, first_chunk, np.minimum(chunk * STEP + CHUNK, (starts + lengths)[of]))


def _responses(net: Network, v: Views) -> np.ndarray:
    """Narrow filters at every position of a text, rectified, and zero beyond its end: (positions, NARROW)."""
    n = len(v.buffer) - WIDTH + 1
    out = np.take(net.filters[0], v.buffer[:n], axis=0, mode="clip")
    for j in range(1, WIDTH):
        out += np.take(net.filters[j], v.buffer[j : j + n], axis=0, mode="clip")
    out += net.bias
    np.maximum(out, 0, out=out)
    beyond = v.first[1:] * STEP - v.starts - v.lengths
    out[np.repeat(v.starts + v.lengths - np.cumsum(beyond) + beyond, beyond) + np.arange(int(beyond.sum()))] = 0
    return out


def _chunk_means(r: np.ndarray, v: Views) -> np.ndarray:
    sums = r.reshape(-1, STEP, NARROW).sum(1)
    both = sums[v.chunk] + np.where((v.chunk * STEP + STEP < v.ends)[:, None], sums[np.minimum(v.chunk + 1, len(sums) - 1)], 0)
    return both / (v.ends - v.chunk * STEP)[:, None].astype(np.float32)


def _pooled(net: Network, pieces: list[tuple[bytes, bytes]]) -> np.ndarray:
    """The pooled values of each piece: (pieces, NARROW + WIDE)."""
    v = Views.of(pieces)
    r = _responses(net, v)
    narrow = np.maximum.reduceat(r.reshape(-1, STEP, NARROW).max(1), v.first[:-1], axis=0)
    wide = np.maximum(_chunk_means(r, v) @ net.wide + net.wide_bias, 0)
    return np.concatenate([narrow, np.maximum.reduceat(wide, v.first_chunk[:-1], axis=0)], 1)


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Of texts of any length: long ones in slices that overlap by a chunk's half, max-pooled again."""
    out = np.zeros((len(texts), NARROW + WIDE), np.float32)
    pieces, owner, size = [], [], 0

    def flush() -> None:
        if pieces:
            np.maximum.at(out, np.array(owner), _pooled(net, pieces))
            pieces.clear()
            owner.clear()

    for i, t in enumerate(texts):
        for k in range(0, max(1, len(t) - STEP), SLICE):
            end = k + SLICE + STEP
            pieces.append((t[k:end], t[end : end + WIDTH]))
            owner.append(i)
            size += len(pieces[-1][0])
            if size >= SLICE:
                flush()
                size = 0
    flush()
    return out


def probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    z = pooled(net, texts) @ net.combine + net.offset[0]
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def _gradients(net: Network, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted log loss; they flow through each pool's winning position or chunk."""
    v = Views.of([(t, b"") for t in texts])
    r = _responses(net, v)
    top = np.stack([s + r[s : s + n].argmax(0) for s, n in zip(v.starts.tolist(), v.lengths.tolist(), strict=True)])
    means = _chunk_means(r, v)
    raw = means @ net.wide + net.wide_bias
    best = np.stack([a + raw[a:b].argmax(0) for a, b in zip(v.first_chunk.tolist(), v.first_chunk[1:].tolist(), strict=False)])
    narrow, wide = np.take_along_axis(r, top, 0), np.maximum(np.take_along_axis(raw, best, 0), 0)
    x = np.concatenate([narrow, wide], 1)
    p = 1 / (1 + np.exp(-np.clip(x @ net.combine + net.offset[0], -30, 30)))
    g = ((p - labels) * weight / len(labels)).astype(np.float32)
    gx = g[:, None] * net.combine
    gw = gx[:, NARROW:] * (wide > 0)
    chunks, place = np.unique(best, return_inverse=True)
    place = place.reshape(best.shape)
    gm = np.zeros((len(chunks), NARROW), np.float32)  # of the winning chunks' means
    grad_wide = np.zeros_like(net.wide)
    for u in range(WIDE):
        np.add.at(gm, place[:, u], gw[:, u, None] * net.wide[:, u])
        grad_wide[:, u] = means[best[:, u]].T @ gw[:, u]
    sizes = v.ends[chunks] - v.chunk[chunks] * STEP
    of = np.repeat(np.arange(len(chunks)), sizes)
    at = v.chunk[chunks][of] * STEP + np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.concatenate([at, top.ravel()])
    gr = np.concatenate([gm[of] / sizes[of][:, None], np.zeros((top.size, NARROW), np.float32)])
    gr[len(of) + np.arange(top.size), np.tile(np.arange(NARROW), len(texts))] = gx[:, :NARROW].ravel()
    gr *= r[at] > 0
    filters = np.empty_like(net.filters)
    columns = np.arange(NARROW)
    for j in range(WIDTH):
        slot = v.buffer[at + j][:, None] * NARROW + columns
        filters[j] = np.bincount(slot.ravel(), weights=gr.ravel(), minlength=256 * NARROW).reshape(256, NARROW)
    return {"filters": filters, "bias": gr.sum(0), "wide": grad_wide + 1e-4 * net.wide, "wide_bias": gw.sum(0), "combine": x.T @ g + 1e-4 * net.combine, "offset": np.array([g.sum()], np.float32)}


def train(texts: list[str], labels: np.ndarray, epochs: int = 12, seed: int = 7) -> Network:
    """Fit by Adam on the log loss, both classes weighing the same.

    With no rows, or rows of one class only, the network answers a constant.
    """
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    raw = [(t or "").encode() for t in texts]
    if not raw or labels.min() == labels.max():
        net.combine[:] = 0
        net.offset[0] = 4.0 * (2 * float(labels[0]) - 1) if raw else 0.0
        return net
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    moment = {k: [np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))] for k in vars(net)}
    step = 0
    for epoch in range(epochs):
        rate = 0.02 if epoch < epochs * 2 // 3 else 0.004
        for rows in np.array_split(rng.permutation(len(raw)), max(1, len(raw) // 64)):
            grads = _gradients(net, [raw[i] for i in rows], labels[rows], weight[rows])
            step += 1
            for k, g in grads.items():
                m, s = moment[k]
                m += 0.1 * (g - m)
                s += 0.001 * (g**2 - s)
                value = getattr(net, k)
                value -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def score(documents: DataFrame, net: Network, text: str = "text", into: str = "score") -> DataFrame:
    """``documents`` with the probability of good quality in ``into`` (replaced if there already)."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(net)  # a fixed 50 KB

    @F.arrow_udf("double")
    @tidy
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [np.zeros(0)]
            for _, _, data, offsets in ta.parts(texts):
                raw = data.tobytes()
                o = offsets.tolist()
                found.append(probabilities(shared.value, [raw[a:b] for a, b in zip(o, o[1:], strict=False)]))
            yield pa.array(np.concatenate(found), pa.float64())

    return documents.withColumn(into, probability(F.col(text).cast("string")))


def classify(documents: DataFrame, labels: DataFrame, rows_per_class: int = 1500, threshold: float = 0.3, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """Fit on the whole texts of at most ``rows_per_class`` labelled training rows of each class, score every whole text.

    Returns the documents with ``held_out``, ``score`` and ``predicted``, each replaced if there already.
    """
    sample = labelled_rows(documents, labels, "quality", modulus, held_out, rows_per_class, 4).orderBy("doc_id").toArrow()
    scored = score(documents, train(sample.column("text").to_pylist(), np.array(sample.column("label").to_pylist(), np.int64)))
    return scored.withColumns(
        {"held_out": F.coalesce(fold("doc_id", modulus) == held_out, F.lit(False)), "predicted": (F.col("score") >= threshold).cast("int")}
    )
