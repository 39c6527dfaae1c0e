"""The classifiers against plain loops over bytes, and what they catch of texts held out."""

import random

import numpy as np
import pytest

TEXTS = ["", " ", "a", "idiot", "The Idiot\tand ÉTÉ a  b", "word " * 700, "x" * 400, "é\n" * 90, "Ab" * 32, "y" * 127, "z " * 64]


def texts():
    rng = random.Random(6)
    return [t.encode() for t in TEXTS] + ["".join(rng.choice("abAB é\n\t!") for _ in range(rng.randint(1, 900))).encode() for _ in range(20)]


def brute_quality(net, text):
    from docketry.llm import quality as q

    text = text or b"\0"
    padded = text + b"\0" * q.WIDTH
    narrow = [[max(0.0, float(net.bias[f]) + sum(float(net.filters[j][padded[p + j]][f]) for j in range(q.WIDTH))) for f in range(q.NARROW)] for p in range(len(text))]
    pooled = [max(r[f] for r in narrow) for f in range(q.NARROW)]
    chunks = [narrow[k : k + 128] for k in range(0, max(1, len(text) - 64), 64)]
    means = [[sum(r[f] for r in c) / len(c) for f in range(q.NARROW)] for c in chunks]
    pooled += [max(max(0.0, float(net.wide_bias[u]) + sum(m[f] * float(net.wide[f][u]) for f in range(q.NARROW))) for m in means) for u in range(q.WIDE)]
    z = float(net.offset[0]) + sum(x * float(c) for x, c in zip(pooled, net.combine, strict=True))
    return 1 / (1 + np.exp(-z))


@pytest.mark.parametrize("size", [1 << 17, 64, 192])
def test_quality_of_whole_and_sliced_texts_equals_loops(size, monkeypatch):
    from docketry.llm import quality as q

    monkeypatch.setattr(q, "SLICE", size)
    net = q.Network.fresh(np.random.default_rng(3))
    net.bias -= 0.5
    got = q.probabilities(net, texts())
    assert got == pytest.approx([brute_quality(net, t) for t in texts()], abs=1e-5)


def test_quality_gradients_are_those_of_the_loss():
    from docketry.llm import quality as q

    net = q.Network.fresh(np.random.default_rng(4))
    some, y, w = [t for t in texts() if t][:8], np.array([0, 1] * 4), np.ones(8)

    def loss():
        p = q.probabilities(net, some)
        return -(np.where(y == 1, np.log(p), np.log(1 - p)) * w).mean()

    grads = q._gradients(net, some, y, w)
    for name in ("filters", "wide", "combine", "wide_bias"):
        value, g = getattr(net, name), grads[name]
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before = value[at]
        value[at] = before + 1e-2
        up = loss()
        value[at] = before - 1e-2
        down = loss()
        value[at] = before
        assert (up - down) / 2e-2 == pytest.approx(float(g[at]), rel=0.1, abs=1e-3), name


def brute_toxicity(model, text):
    from docketry.llm import toxicity as t

    separators = b" \t\n\x0b\x0c\r"
    data = bytes(32 if b in separators else b + 32 if 65 <= b <= 90 else b for b in b" " + text + b" ")
    vectors = []
    for size in (*t.SIZES, *t.EDGE_SIZES):
        for p in range(len(data) - size + 1):
            gram = data[p : p + size]
            if b" " in gram[1:-1] or (size in t.EDGE_SIZES and gram[:1] != b" "):
                continue
            h = 0
            for b in gram:
                h = (h * 0x01000193 + b + 1) % 2**32
            x = (h ^ size) * 0x9E3779B1 % 2**32
            x = (x ^ x >> 15) * 0x85EBCA77 % 2**32
            vectors.append(model.embeddings[x >> 12])
    mean = sum(vectors, np.zeros(t.DIM)) / (len(vectors) + t.NEUTRAL)
    logits = mean @ model.weights + model.bias
    return float(np.exp(logits[1]) / np.exp(logits).sum())


@pytest.mark.parametrize("size", [1 << 20, 16, 100])
def test_toxicity_of_whole_and_sliced_texts_equals_loops(size, monkeypatch):
    from docketry.llm import toxicity as t

    monkeypatch.setattr(t, "SLICE", size)
    rng = np.random.default_rng(5)
    model = t.Model(rng.normal(0, 3, (t.BUCKETS, t.DIM)).astype(np.float32), rng.normal(size=(t.DIM, 2)), rng.normal(size=2))
    got = t.probabilities(model.evidence(), float(model.bias[1] - model.bias[0]), texts())
    assert got == pytest.approx([brute_toxicity(model, x) for x in texts()], abs=1e-4)


@pytest.mark.parametrize(("name", "target", "recall", "lost"), [("quality", "quality", 0.9, 0.01), ("toxicity", "toxic", 0.8, 0.005)])
def test_what_is_caught_of_texts_held_out(spark, name, target, recall, lost):
    import importlib

    module = importlib.import_module(f"docketry.llm.{name}")
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{base}/labels.parquet")
    scored = module.classify(docs, labels).filter("held_out").join(labels, "doc_id").select("predicted", target).collect()
    bad = 0 if name == "quality" else 1  # poor or toxic texts are to be caught, the others left alone
    caught = [r.predicted == bad for r in scored if r[target] == bad]
    wrong = [r.predicted == bad for r in scored if r[target] == 1 - bad]
    print(f"{name}: caught {sum(caught)} of {len(caught)}, and {sum(wrong)} of {len(wrong)} others")
    assert sum(caught) >= recall * len(caught)
    assert sum(wrong) <= lost * len(wrong)


@pytest.mark.parametrize(("name", "target"), [("quality", "quality"), ("toxicity", "toxic")])
def test_long_null_and_repeated_labelled_texts_take_part(spark, name, target):
    import importlib

    module = importlib.import_module(f"docketry.llm.{name}")
    rows = [(k, ("plain words of a text " if k % 2 else "trash scum loser !! ") * (3000 if k < 4 else 5)) for k in range(60)] + [(60, None), (5, "plain words of a text " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' held_out", "'y' predicted")
    labels = spark.createDataFrame([(k, k % 2 if target == "quality" else 1 - k % 2) for k in range(61)] + [(7, None), (8, 5)], f"doc_id long, {target} int")
    got = module.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(isinstance(r.held_out, bool) and r.predicted in (0, 1) for r in got)
    scores = {r.doc_id: r.score for r in got}
    assert (np.mean([scores[k] for k in range(1, 60, 2)]) > np.mean([scores[k] for k in range(0, 60, 2)])) == (target == "quality")
    assert len({round(r.score, 5) for r in got if r.doc_id == 5}) == 1
