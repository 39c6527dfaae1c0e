"""Fill-in-middle, token counts and vector codes against plain versions and the library."""

import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from docketry.llm import fim, tokencounts, vectorcodes

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def texts(spark, rows):
    return spark.createDataFrame([(i, t, "a", 5, "b") for i, t in rows], "doc_id long, text string, n string, n_tokens int, fim string")


# fill-in-middle


@pytest.mark.parametrize("kind", ["char", "word", "line"])
def test_ropes_split_anywhere_and_go_together_again(kind):
    rng = random.Random(3)
    for size in (1, 3, 7, 50):
        for text in ("", " ", "a", " two  words\n\nand é𝄞 lines\n", "".join(rng.choice("ab \né𝄞") for _ in range(300))):
            whole = fim.rope(text, kind, size)
            units = list(text) if kind == "char" else [m.group() for m in fim.UNITS[kind][0].finditer(text)]
            assert fim.string(whole) == text == "".join(units)
            assert (whole.units, whole.points) == (len(units), len(text))
            for k in {0, 1, len(units) // 3, len(units) // 2, len(units)} if units else {0}:
                left, right = fim.split(whole, min(k, len(units)))
                assert fim.string(left) == "".join(units[:k]) and fim.string(right) == "".join(units[k:])
                assert left.units + right.units == len(units) and left.points + right.points == len(text)


def test_rope_of_a_long_text_is_shallow_and_shares_its_leaves():
    whole = fim.rope("x" * 1_000_000, size=100)

    def depth(r):
        return 1 + max(depth(r.left), depth(r.right)) if isinstance(r, fim.Node) else 0

    assert depth(whole) <= 14
    left, right = fim.split(whole, 333_333)
    assert depth(left) <= 20 and depth(right) <= 20
    assert fim.string(fim.concat(right, left)) == "x" * 1_000_000


def plain_fim(doc_id, text):
    text = text or ""
    digest = sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_plain_cuts_and_is_undone(spark):
    rng = random.Random(1)
    odd = [None, "", "a", "<", "<P", "has <M> inside", "<<S<S>", "é𝄞" * 5, "x<" * 40, "<S" * 30, ">M<" * 30, "long " * 40_000]
    rows = [(k, t) for k, t in enumerate(odd * 20)] + [(k, "".join(rng.choice("<>PSM é\n") for _ in range(rng.randint(0, 60)))) for k in range(1000, 1400)]
    rows += rows[:5]
    got = fim.restore(fim.fill_in_middle(texts(spark, rows))).collect()
    want = sorted(((i, *plain_fim(i, t), t or "") for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.fim, r.restored) for r in got), key=repr) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(texts(spark, [])).count() == 0
    (null_id,) = fim.fill_in_middle(texts(spark, [(None, "abc def")])).collect()
    assert (null_id.n, null_id.form, null_id.fim.replace("<P>", "").replace("<S>", "").replace("<M>", "") != "") == (7, plain_fim("", "abc def")[1], True)


@pytest.mark.parametrize("unit", ["word", "line"])
def test_fill_in_middle_by_other_units_is_undone(spark, unit):
    rows = [(k, " one two\nthree  four\n\nfive " * (k % 7)) for k in range(60)]
    made = fim.restore(fim.fill_in_middle(texts(spark, rows), unit=unit, plain_from=100)).collect()
    for r in made:
        assert r.restored == dict(rows)[r.doc_id]
        if r.form != "plain":
            middle = r.fim[r.fim.index("<M>") + 3 :]
            assert not middle or fim.UNITS[unit][0].match(middle)
    with pytest.raises(ValueError, match="unit"):
        fim.fill_in_middle(texts(spark, rows), unit="page")


# token counts


def library(values):
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(BYTE_BPE).encode_batch([v or "" for v in values], add_special_tokens=False)]


PIECES = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "''", "'S", "a", "S", "t", "re", "ing", "é", "中", "文", "1", "23", "٣", "<|endoftext|>", "<|endof", "text|>", "!", "…", "\xa0", " ", "\x85", "\r", "👍", "ा", "हि", "̀", "aaaa", "\x1c", "\0", "ǅ", "²", "Ⅷ", "​", "᠎"]


def test_token_counts_equal_the_library():
    rng = random.Random(5)
    values = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + [None, "", " "]
    values += ["a" * 50_000, "ab" * 20_000, "".join(rng.choice("abcdefgh") for _ in range(30_000)), "\n" * 5000, "'s" * 3000]
    assert tokencounts.counter(BYTE_BPE).count_column(pa.array(values)).tolist() == library(values)


def test_long_texts_are_counted_in_pieces(monkeypatch):
    rng = random.Random(6)
    values = ["".join(rng.choice([*PIECES, "word", " word"]) for _ in range(800)) for _ in range(30)] + ["no,blanks," * 300]
    monkeypatch.setattr(tokencounts.ta, "CHUNK_BYTES", 256)
    monkeypatch.setattr(tokencounts.ta.parts, "__defaults__", (256,))
    assert tokencounts.counter(BYTE_BPE).count_column(pa.array(values)).tolist() == library(values)


def test_rounds_merge_as_one_pair_at_a_time_does():
    c = tokencounts.counter(BYTE_BPE)
    rng = random.Random(7)
    words = [bytes(rng.choice(b"aabehinort ") for _ in range(rng.randint(1, 25))) for _ in range(500)] + [b"a" * n for n in range(1, 40)]

    def one_at_a_time(word):
        symbols = [int(c.by_byte[b]) for b in word]
        while True:
            ranks = [int(c.rank(np.array([a]), np.array([b]))[0]) for a, b in zip(symbols, symbols[1:], strict=False)]
            if not ranks or min(ranks) == tokencounts.NO_RANK:
                return len(symbols)
            k = ranks.index(min(ranks))
            symbols[k : k + 2] = [int(c.result[ranks[k]])]

    data = np.frombuffer(b"".join(words), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    assert c.lengths(data, offsets).tolist() == [one_at_a_time(w) for w in words]


def test_counted_documents(spark):
    rows = [(1, None), (2, ""), (3, "a b <|endoftext|> c"), (3, "a b <|endoftext|> c"), (None, "é"), (5, "word " * 600)]
    got = tokencounts.count_tokens(texts(spark, rows), BYTE_BPE).collect()
    want = [(i, len((t or "").encode()), n, n > 512, "a") for (i, t), n in zip(rows, library([t for _, t in rows]), strict=True)]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit, r.n) for r in got), key=repr) == sorted(want, key=repr)
    assert tokencounts.count_tokens(texts(spark, []), BYTE_BPE).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokencounts.Counter(public_tokenizers.path("word_bpe_49k.json"))


# vector codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Lloyd rounds on Python integers; rows are (id, whole numbers), sorted by id."""
    width = len(rows[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in rows]
    books = [[list(cut[r][p]) for r in range(min(entries, len(rows)))] for p in range(parts)]

    def distance(x, c):
        return sum((a - b) ** 2 for a, b in zip(x, c, strict=True))

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (distance(row[p], books[p][e]), e)) for p in range(parts)] for row in cut]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                of = [row[p] for row, n in zip(cut, near, strict=True) if n[p] == e]
                if of:
                    books[p][e] = [sum(x) // len(of) for x in zip(*of, strict=True)]
    near = assign()
    return ["".join(f"{e:02x}" for e in n) for n in near], [sum(distance(row[p], books[p][n[p]]) for p in range(parts)) for row, n in zip(cut, near, strict=True)], books


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, label, 1) for i, v, label in rows], f"vec_id long, embedding array<{kind}>, label int, error int")


def whole(v):
    return [int(x) * 256 if abs(x) >= 2**60 else int(np.floor(x * 256)) for x in v]


@pytest.mark.parametrize("scale", [0.1, 3.0, 1e5, 1e18, 1e40])
def test_codes_equal_plain_lloyd_rounds(spark, scale):
    rng = np.random.default_rng(int(scale) % 97)
    centres = rng.normal(size=(5, 16))
    v = [(scale * (centres[k % 5] + 0.2 * rng.normal(size=16))).tolist() for k in range(220)]
    v[30], v[31] = v[29], v[29]  # ties and repeats
    rows = [(k * 3, x, k % 4 if k % 9 else None) for k, x in enumerate(v)]
    bad = [(1, None, 1), (2, [float("nan")] * 16, 1), (4, [None] * 16, 2), (5, [float("inf")] * 16, 2)]
    got = vectorcodes.compress(vectors(spark, rows + bad), parts=4, entries=16, rounds=3, rows=64)
    codes, errors, books = plain_codes([(i, whole(x)) for i, x, _ in rows], 4, 16, 3)
    assert got.codebooks == books
    fits = [e if e < 2**63 else None for e in errors]
    found = vectorcodes.with_label_errors(got.rows).orderBy("vec_id").collect()
    assert [(r.vec_id, r.label, r.code, r.error) for r in found] == [(i, label, c, e) for (i, _, label), c, e in zip(rows, codes, fits, strict=True)]
    for r in found:
        of = [e for (_, _, label), e in zip(rows, fits, strict=True) if label == r.label]
        assert r.label_error == (None if None in of or sum(of) >= 2**63 else sum(of))
    assert got.sha256 == sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    if scale <= 1e5:
        assert got.scanned[0] == 220 * 4 and got.scanned[2] < 220 * 4


def test_bounds_spare_most_scans_once_entries_settle(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 8)) * 5
    rows = [(k, (centres[k % 8] + 0.05 * rng.normal(size=8)).tolist(), 0) for k in range(2000)]
    got = vectorcodes.compress(vectors(spark, rows), parts=2, entries=8, rounds=4)
    assert got.scanned[0] == 4000 and got.scanned[3] < 400


def test_codes_of_few_and_odd_vectors(spark):
    assert vectorcodes.compress(vectors(spark, [])).rows.count() == 0
    assert vectorcodes.compress(vectors(spark, [])).sha256 == sha256(b"").hexdigest()
    empty = vectorcodes.compress(vectors(spark, [(1, [], 1), (2, None, 1)]), parts=2, entries=4).rows.collect()
    assert [(r.vec_id, r.code, r.error) for r in empty] == [(1, "0000", 0)]
    few = vectorcodes.compress(vectors(spark, [(None, [1.0, 2.0, 3.0], None), (7, [1.0], 2), (7, [1.0], 2)], "float"), parts=2, entries=4)
    rows = sorted(((r.vec_id, r.label, r.code, r.error) for r in few.rows.collect()), key=repr)
    assert rows == [(7, 2, "0000", 0), (7, 2, "0000", 0), (None, None, "0202", 0)]
    assert few.codebooks == [[[256, 0], [256, 0], [256, 512]], [[0, 0], [0, 0], [768, 0]]]
