"""Word hashes of structured words, scores of very large components, and bucket counts by size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import hasharrays, textarrays, topk


def thue_morse(n):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(n))


def hashes(*texts):
    raw = [t.encode() for t in texts]
    h, bounds = textarrays.word_hashes(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    return [h[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]


@pytest.mark.parametrize("n", [2, 64, 65, 1024, 4096])
def test_structured_words_have_hashes_of_their_own(n):
    word = thue_morse(n)
    other = word.translate(str.maketrans("ab", "ba"))
    (a,), (b,), (c,), (d, e) = hashes(word, other, word.upper(), f" {word}\t{other} ")
    assert a == c == d and b == e and a != b


def test_words_differ_by_place_and_length():
    words = ["a" * k for k in range(1, 200)] + ["ab", "ba", "a" * 100 + "b", "b" + "a" * 100] + ["\0" * k for k in range(1, 5)]
    found = [h for (h,) in hashes(*words)]
    assert len(set(found)) == len(words)


def search(spark, rows, k=2):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(frame, F.col("vec_id") == 0, k).orderBy("rank").collect()
    return [(r.vec_id, r.score) for r in got]


def test_one_large_component_stops_nothing(spark):
    large, unit = [6e6] + [0.0] * 63, [1.0] + [0.0] * 63
    assert search(spark, [(0, unit), (1, large), (2, [0.5] + [0.0] * 63)]) == [(1, 64 * 64 * 6_000_000), (2, 64 * 32)]
    # bounds beyond 64 bits, scores within
    wide = [[1e9, -1e9] * 32, [1e9, 1e9] * 32, [1.0, 1.0] * 32]
    assert search(spark, [(0, wide[2]), (1, wide[0]), (2, wide[1])]) == [(2, 64 * 64 * 64 * 10**9), (1, 0)]
    rows = [(k, [float(x) for x in np.random.default_rng(k).integers(-(10**7), 10**7, 8)]) for k in range(60)]
    whole = {k: [64 * int(x) for x in v] for k, v in rows}
    want = sorted(((-sum(a * b for a, b in zip(whole[0], v, strict=True)), k) for k, v in whole.items() if k), key=lambda x: x)[:5]
    assert search(spark, rows, 5) == [(k, -s) for s, k in want]


def test_scores_that_do_not_fit_are_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        search(spark, [(0, [1e9, 1e9]), (1, [1e9, 1e9])])


def test_buckets_grow_with_the_texts(spark):
    assert hasharrays.bucket_bits(spark) == hasharrays.bucket_bits(spark, 1 << 30) == 8
    assert 1 << hasharrays.bucket_bits(spark, 1 << 40) >= (1 << 40) // hasharrays.BUCKET_BYTES
