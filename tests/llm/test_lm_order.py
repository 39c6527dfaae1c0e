"""The language model at orders above 2, against brute force over tuples of words."""

import collections
import math
import random
import zlib

import pytest


def brute_model(texts, order, discounts):
    """P(w after a tuple of words), by the definition, from lists of tokens."""
    counts = [collections.Counter() for _ in range(order + 1)]
    for tokens in texts:
        padded = ["<s>"] * (order - 1) + tokens
        for at in range(order - 1, len(padded)):
            counts[order][tuple(padded[at - order + 1 : at + 1])] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    sizes = [collections.Counter(c.values()) for c in counts]
    d = [discounts([s[n] for n in (1, 2, 3, 4)]) for s in sizes]
    total, free = collections.Counter(), collections.Counter()
    for k in range(1, order + 1):
        for gram, n in counts[k].items():
            total[gram[:-1]] += n
            free[gram[:-1]] += d[k][min(n, 3)]

    def p(context, w):
        k = len(context) + 1
        low = p(context[1:], w) if context else 1 / (len(counts[1]) + 1)
        if not total[context]:
            return low
        n = counts[k][*context, w]
        return (n - d[k][min(n, 3)]) / total[context] + free[context] / total[context] * low

    return p, [g[0] for g in counts[1]]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_of_any_order_equal_brute_force(spark, order):
    from docketry.llm import kneserney as kn

    rng = random.Random(order)
    rows = [(k, " ".join(rng.choice("the of a cat dog runs far".split()) for _ in range(rng.randint(0, 14)))) for k in range(90)] + [(98, None), (99, "the unseen words of a cat runs")]
    texts = {i: [*(t or "").split(), None] for i, t in rows}
    p, words = brute_model([t for i, t in texts.items() if i < 70], order, kn.discounts)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in kn.score(docs, kn.train(docs.filter("doc_id < 70"), order=order)).collect()}
    for i, tokens in texts.items():
        padded = ["<s>"] * (order - 1) + tokens
        want = sum(math.log10(p(tuple(padded[k : k + order - 1]), w)) for k, w in enumerate(tokens))
        assert got[i] == pytest.approx(want), i
    for context in (("<s>",) * (order - 1), ("the", "of", "a")[: order - 1], ("dog", "unseen", "cat")[: order - 1]):
        assert sum(p(context, w) for w in [*words, "@"]) == pytest.approx(1)
    assert all(r.score == 0 for r in kn.score(docs, kn.train(docs.limit(0), order=order)).collect())


def test_the_query_tells_texts_apart_by_two_words_before(spark, tmp_path):
    from docketry.llm.queries import QUERIES

    # after "a b" comes c, after "x b" comes d: with one word before, c and d are as likely
    training = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 != 2]
    held_out = next(k for k in range(200) if k not in training)
    rows = [(k, "a b c" if n % 2 else "x b d") for n, k in enumerate(training)] + [(held_out, "a b c"), (held_out, "a b d")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    right, wrong = sorted((r.score for r in QUERIES["op2_lm_scoring"](spark, str(tmp_path)).collect() if r.held_out), reverse=True)
    assert right - wrong > 1


def test_counts_and_runs_of_any_size_come_back():
    import numpy as np

    from docketry.llm import hasharrays as ha
    from docketry.llm import kneserney as kn

    counts = np.array([1, 254, 255, 256, 70_000, 3, 255], np.uint64)
    stored = ha.escaped(counts)
    assert stored["counts"].dtype == np.uint8
    assert ha.unescaped(stored, np.array([4, 0, 6, 2, 1])).tolist() == [70_000, 1, 255, 255, 254]

    rng = np.random.default_rng(1)
    runs = [np.unique(rng.integers(0, 500, n)) for n in (1, 3, 16, 17, 300)]
    words, ends = np.concatenate(runs), np.cumsum([len(r) for r in runs])
    run, wanted = np.repeat(np.arange(5), 510), np.tile(np.arange(510), 5)
    at = kn._within(words, (ends - [len(r) for r in runs])[run], ends[run], wanted)
    for r, w, a in zip(run, wanted, at, strict=True):
        assert (words[a] == w and ends[r] - len(runs[r]) <= a < ends[r]) if w in runs[r] else a == -1


def test_contexts_of_many_words_and_large_counts_equal_brute_force(spark):
    from docketry.llm import kneserney as kn

    texts = [f"so it is {i}" for i in range(60) for _ in range(1 + i % 3)] + ["so it"] * 300
    asked = ["so it is 7 0 so it is 90", "so it", "it is 59"]
    p, _ = brute_model([[*t.split(), None] for t in texts], 3, kn.discounts)
    model = kn.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), order=3)
    got = {r.doc_id: r.score for r in kn.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(asked):
        padded = ["<s>", "<s>", *t.split(), None]
        assert got[i] == pytest.approx(sum(math.log10(p(tuple(padded[k - 2 : k]), padded[k])) for k in range(2, len(padded))))
