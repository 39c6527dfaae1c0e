"""What the language model's lookups cost and give: files of a level are looked at once a group, different numbers with their places, merged counts."""

import collections

import numpy as np
import pyarrow as pa
import pytest


class Here:
    """A frame whose batches are worked on in this process."""

    def __init__(self, frame, batches):
        self.sparkSession, self.schema, self.batches = frame.sparkSession, frame.schema, batches

    def select(self, *_):
        return self

    def mapInArrow(self, work, _):
        return [r for b in work(iter(self.batches)) for r in b.to_pylist()]


@pytest.mark.parametrize("order", [2, 3])
def test_a_group_of_texts_looks_at_each_file_of_ngrams_once(spark, monkeypatch, order):
    from docketry.llm import hasharrays as ha
    from docketry.llm import kneserney as kn

    rows = [(k, " ".join(f"w{k * n % 37}" for n in range(1, 12))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = kn.train(docs, order=order)
    wanted = {r.doc_id: r.score for r in kn.score(docs, model).collect()}
    seen, get = collections.Counter(), ha.get
    monkeypatch.setattr(ha, "get", lambda folder, name: seen.update([name]) or get(folder, name))
    ids, texts = zip(*rows, strict=True)
    got = kn.score(Here(docs, [pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], names=["doc_id", "text"])]), model)
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx(wanted)
    grams = {name: n for name, n in seen.items() if name.startswith("g")}
    assert grams and set(grams.values()) == {1}


def test_different_numbers_and_their_places_come_back():
    from docketry.llm import hasharrays as ha

    rng = np.random.default_rng(3)
    close = (np.uint64(1) << np.uint64(63)) + rng.integers(0, 5, 3000).astype(np.uint64)  # equal but for their lowest bits
    for values in (
        np.zeros(0, np.uint64),
        np.full(5, 7, np.int64),
        rng.integers(-1, 40, 500),
        rng.integers(-(1 << 63), 1 << 63, 2000),
        rng.integers(0, 1 << 64, 2000, dtype=np.uint64),
        np.concatenate([close, close[::-1], np.array([0, 1, (1 << 64) - 1], np.uint64)]),
    ):
        unique, which, place = ha.distinct(values)
        wanted, inverse = np.unique(values, return_inverse=True)
        assert unique.tolist() == wanted.tolist() and which.tolist() == inverse.tolist()
        assert values[place].tolist() == unique.tolist()


def test_counts_of_a_buckets_blobs_are_added_up():
    from docketry.llm import hasharrays as ha

    rng = np.random.default_rng(4)
    wanted, blobs = [collections.Counter(), collections.Counter()], [[], []]
    for n in range(10):
        keys = np.unique(rng.integers(0, 300, 120)).astype(np.uint64)
        counts = rng.integers(1, 4, len(keys)).astype(np.uint64) * np.uint64(1 + 400 * (n == 3))
        wanted[n % 2].update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        blobs[n % 2].append(ha.pack(keys, counts))
    batch = pa.RecordBatch.from_pydict({"bucket": [0] * 5 + [1] * 5, "blob": blobs[0] + blobs[1]})
    for bucket, keys, counts in ha.by_bucket(iter([batch])):
        assert keys.tolist() == sorted(wanted[bucket])
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == wanted[bucket]
