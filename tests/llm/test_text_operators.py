"""Operators on documents: edge cases and comparisons with brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    """Rows (doc_id, text), with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en", f"src{(i or 0) % 5}", 0.5, 1, "x") for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, n long, ids string")


EDGE = [(1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "a b c d e f g h"), (6, "a b c d e f g h"), (5, "a b c d e f g h"), (None, "a b c d e f g h"), (7, "word " * 30_000)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_bpe_equals_the_library(spark, vocabulary):
    from tokenizers import Tokenizer

    from docketry.llm import bpe

    rng = random.Random(3)
    parts = ["a", "the", "'s", "!!", "12", " ", "\n", "é", "東京", "İ", "<|endoftext|>", "x" * 50, "ing", "😀"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 200)))) for k in range(40)]
    rows += [(100, "".join(rng.choice("abcdef") for _ in range(9000))), (101, "".join(rng.choice("abc de'!") for _ in range(9000)))] + EDGE
    got = bpe.decode(bpe.encode(documents(spark, rows), vocabulary, long=1500), vocabulary).collect()
    library = Tokenizer.from_file(vocabulary)
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(documents(spark, []), vocabulary).count() == 0


def test_joins_of_halves_are_exact(vocabulary):
    from tokenizers import Tokenizer

    from docketry.llm import bpe

    c, library, rng = bpe.codec(vocabulary), Tokenizer.from_file(vocabulary), random.Random(5)
    for n in range(60):
        text = "".join(rng.choice("abcdefghi'é!" if n % 2 else "ab ") for _ in range(rng.randint(1, 3000)))
        size = rng.choice([1, 3, 64, 600])
        pieces = [bpe.Encoded.of(c, p) for _, p, _ in bpe.cut(c, text, size)]
        assert bpe.join_all(c, pieces).tolist() == library.encode(text, add_special_tokens=False).ids


def test_lm_scores_equal_brute_force(spark):
    from docketry.llm import kneserney as kn

    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice("the of a cat Dog runs far".split()) for _ in range(rng.randint(0, 12)))) for k in range(60)] + [(99, "unseen words"), (98, None)]
    texts = {i: [*words(t), None] for i, t in rows}
    train = [i for i in texts if i < 50]
    one, two = collections.Counter(), collections.Counter()
    for i in train:
        for h, w in zip(["<s>", *texts[i]], texts[i], strict=False):
            one[w] += 1
            two[h, w] += 1
    sizes = collections.Counter(two.values())
    before = collections.Counter(w for _, w in two)
    lower_sizes = collections.Counter(before.values())
    d, e = kn.discounts([sizes[k] for k in (1, 2, 3, 4)]), kn.discounts([lower_sizes[k] for k in (1, 2, 3, 4)])
    total, free = collections.Counter(), collections.Counter()
    for (h, _), n in two.items():
        total[h] += n
        free[h] += d[min(n, 3)]
    freed = sum(e[min(n, 3)] for n in before.values()) / len(two)

    def p(h, w):
        low = (max(before[w] - e[min(before[w], 3)], 0) if w in before else 0) / len(two) + freed / (len(one) + 1)
        return low if h not in total else max(two[h, w] - d[min(two[h, w], 3)], 0) / total[h] + free[h] / total[h] * low

    docs = documents(spark, rows)
    got = {r.doc_id: r for r in kn.score(docs, kn.train(docs.filter("doc_id < 50"))).collect()}
    n = sum(one.values())
    for i, tokens in texts.items():
        assert got[i].score == pytest.approx(sum(math.log10(p(h, w)) for h, w in zip(["<s>", *tokens], tokens, strict=False)))
        assert got[i].base_score == pytest.approx(sum(math.log10((one[w] + 1) / (n + len(one) + 1)) for w in tokens))
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(tokens), sum(w in one for w in tokens), n)
    assert sum(p("the", w) for w in [*one, "@"]) == pytest.approx(1)
    empty = kn.score(docs, kn.train(docs.limit(0))).collect()
    assert all(r.score == 0 for r in empty)


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets.setdefault(i, []).append(frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, width, percent):
    from docketry.llm import jaccard

    rng = random.Random(width)
    vocab = [f"w{k}" for k in range(300)]
    shared = [rng.choice(vocab) for _ in range(57)]  # a passage of many documents
    rows = []
    for k in range(60):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 9, 60]))]
        if k % 3 == 0:
            base = shared + base[: rng.choice([3, 6, 9, 14])]
        rows.append((k, " ".join(base)))
        for c in range(3):  # chains of near copies
            base = list(base)
            base[rng.randrange(len(base))] = rng.choice(vocab)
            rows.append((100 + 10 * k + c, " ".join(base)))
    rows += [(9001, None), (9002, ""), (9003, "  "), (9004, "one"), (9005, "one"), (9004, "one")]
    want = brute_components(rows, width, percent)
    got = jaccard.join(documents(spark, [*rows, (None, "one")]), width, percent).collect()
    assert len(got) == len(rows) + 1
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert next(r for r in got if r.doc_id is None).component_id is None
    assert jaccard.join(documents(spark, []), width, percent).count() == 0


def brute_lines(rows):
    lines = [(i, zlib.crc32(b""), k, tuple(w for w in re.split(r"[ \t\x0B-\x0D]+", x.lower()) if w), x) for i, t in rows if t is not None for k, x in enumerate(t.split("\n"))]

    def near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        head = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        tail = next((k for k, (x, y) in enumerate(zip(a[::-1], b[::-1], strict=False)) if x != y), min(len(a), len(b)))
        return head + tail >= max(len(a), len(b)) - 1

    kept = collections.defaultdict(list)
    for n, (i, _, _, w, x) in enumerate(lines):
        if not w or not any(v == w or (len(w) >= 4 and len(v) >= 4 and near(v, w)) for *_, v, _ in lines[:n]):
            kept[i].append(x)
    return {i: None if t is None else "\n".join(kept[i]) for i, t in rows}


def test_line_dedup_equals_brute_force(spark):
    from docketry.llm import lines

    rng = random.Random(2)
    pool = [[rng.choice("red blue green cat dog sun moon".split()) for _ in range(rng.randint(1, 9))] for _ in range(25)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(pool))
            if rng.random() < 0.6:
                line[rng.randrange(len(line))] = rng.choice("X Y Z".split())
            if rng.random() < 0.2:
                line.pop(rng.randrange(len(line)))
            text.append(" ".join(line))
        rows.append((i, "\n".join(text)))
    rows += [(50, None), (51, ""), (52, " "), (53, "long line " * 3000), (54, "long line " * 2999 + "end")]
    got = lines.dedup_lines(documents(spark, rows)).collect()
    assert {r.doc_id: r.text for r in got} == brute_lines(rows)
    twice = lines.dedup_lines(documents(spark, [(1, "a b c d e\nx"), (1, "a b c d e\nx")])).collect()
    assert [r.text for r in twice] == ["a b c d e\nx"] * 2  # the same document
    assert lines.dedup_lines(documents(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_classifiers_score_every_row(spark, name):
    import importlib

    module = importlib.import_module(f"docketry.llm.{name}")
    target = {"quality": "quality", "toxicity": "toxic"}[name]
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(40)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = [(k, "plain words of a text " * 5 + ("idiot$$$ moron### " * 6 if (k % 2 == 1) == (target == "toxic") else "")) for k in range(40)] + [(k + 100 if k else None, t) for k, t in EDGE]
    docs = documents(spark, rows)
    got = module.classify(docs, labels).select("doc_id", "held_out", "score", "predicted", "n").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.n == 1 for r in got)
    constant = module.classify(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in constant] == [0.5]
    assert module.classify(documents(spark, []), labels).count() == 0
    a = [r.score for r in got if r.doc_id == 107]
    assert a and a[0] == pytest.approx(module.classify(docs.filter("doc_id = 107 or doc_id < 40"), labels).filter("doc_id = 107").first().score)


def test_mixing_spends_the_budget(spark):
    from docketry.llm import mixing

    rng = random.Random(4)
    rows = [(k, " ".join(["w"] * rng.randint(0, 9)), rng.choice(["en", "de", None]), f"src{rng.choice([0, 0, 0, 1, 2, 3, 4])}" if k % 9 else None) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(docs, fraction=0.5, domain_weights={"d0": 1, "d1": 5}).collect()
    size = {i: len(words(t)) for i, t, *_ in rows}
    total = sum(size.values())
    spent = sum(size[r.doc_id] * r.epochs for r in got)
    leaves = len({(lang, source) for _, _, lang, source in rows})
    assert total // 2 - leaves * 10 <= spent <= total // 2
    assert {r.epochs for r in got} == {1} and len({r.doc_id for r in got}) == len(got)
    again = mixing.mix(docs.repartition(7), fraction=0.5, domain_weights={"d0": 1, "d1": 5}).collect()
    assert sorted(r.doc_id for r in again) == sorted(r.doc_id for r in got)
    twice = mixing.mix(docs, fraction=1.5, max_epochs=2).collect()
    assert {r.epochs for r in twice} == {1, 2}
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(documents(spark, EDGE)).count() > 0


def test_shortages_stay_within_the_parent_first(spark):
    from docketry.llm import mixing

    leaves = spark.createDataFrame(
        [("d0", "en", "a", 10), ("d0", "en", "b", 1000), ("d0", "de", "c", 30), ("d1", "en", "e", 5000)], "domain string, lang string, source string, tokens long"
    )
    got = {r.source: r.budget for r in mixing.leaf_budgets(leaves, 0.1, 1, {}, {}, {}).collect()}
    # 604 tokens: 302 a domain; in d0 de gives 30 and en takes the rest; there a gives 10 and b takes the rest
    assert got == {"a": 10, "b": 262, "c": 30, "e": 302}


def test_pipeline_stages_match_brute_force(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in kept.collect()} if name != "toxicity" else None
        out = stage(spark, kept, SF)
        if name != "bpe":
            assert out.columns == docs.columns
        if name == "line_dedup":
            want = {i: t for i, t in brute_lines(sorted(before.items())).items() if t.strip() or t == before[i]}
            assert {r.doc_id: r.text for r in out.collect()} == want
        if name == "jaccard_join":
            smallest = brute_components(list(before.items()), 5, 80)
            assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, c in smallest.items() if i == c)
        if name == "bpe":
            assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and len(r.ids) == 4 * r.n_tokens for r in out.collect())
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}"
        out.write.mode("overwrite").parquet(path)
        kept = spark.read.parquet(path)
        assert kept.count() > 0
