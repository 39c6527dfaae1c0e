"""Acts: footnotes, provisions and places in texts, against plain versions on Python's own expressions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docketry.operators import footnotes, matches, provisions

ACT = """**1. Short title.** Called 1[the Act].
Subs. by Act 12 of 1999, for "old words" (w.e.f. 1-2-2000).
**Section 2A. Powers .-** The 2[board] and 3[none] and 9[x].
1. Ins. by Act 5 of 2001, s. 3
2. vide notification No. 7/2002
3. short
2. Re-numbered as 2B by Act 6 of 2003
**3. Last**
Subs. by Act 12 of 1999, for "old words" (w.e.f. 1-2-2000).
Subs. by Act 12 of 1999, for "old words" (w.e.f. 1-2-2000).
Vide notification No. 8/2004
"""


def plain_footnotes(text):
    """Three sources, one after the other; a dictionary keeps the first of a text and section."""
    headers = [(m.start(), m[1], m[2].strip(" .-")) for m in re.finditer(footnotes.HEADER.replace("(?md)", "(?m)"), text)]
    amend, notify = re.compile(footnotes.AMENDMENT), re.compile(footnotes.NOTIFICATION)
    bodies = {int(m[1]): m[2].strip() for m in re.finditer(footnotes.NUMBERED.replace("(?md)", "(?m)"), text) if len(m[2].strip()) > 10}
    found = {}

    def add(at, number, line, match):
        section = next(((n, t) for p, n, t in reversed(headers) if p <= at), (None, None))
        original, day = re.search(footnotes.REPLACED, line), re.search(footnotes.EFFECTIVE, line)
        kind = next((v for k, v in footnotes.BY_OPENING if match[1].lower().startswith(k)), "renumbering") if match else "note"
        row = (*section, number, line.strip()[:2000], kind, match[2] if match else None, original[1] if match and original else None, day[1] if match and day else None, at)
        found.setdefault((line.strip()[:2000], section[0]), row)

    for m in re.finditer(footnotes.MARK, text):
        body = bodies.get(int(m[1]), "")
        if hit := amend.search(body):
            add(m.start(), int(m[1]), hit[0], hit)
        elif notify.search(body):
            add(m.start(), int(m[1]), body, None)
    for m in amend.finditer(text):
        add(m.start(), None, m[0], m)
    for m in notify.finditer(text):
        add(m.start(), None, m[0], None)
    return sorted(found.values(), key=repr)


def test_footnotes_of_acts_equal_a_plain_version(spark):
    rng = random.Random(2)
    parts = ["**1. A title.** ", "**Section 12A. B -**", "\n", " ", "1[x]", "02[y]", "3[", "\n1. Subs. by Act 3 of 1990, for \"a b\", w.e.f. 1-1-1991\n", "\n2 Omitted by Act 4 of 1992\n", "\n3. too short\n", "vide notification No. 5/6 of x",
             "\n1. a note of no kind at all\n", "Re-numbered as 5 by Act 7 of 2000.", "added by act 9 of 2009", "\n2. see vide notification No. 9\n", "words"]
    texts = [ACT, "", "no notes"] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(150)]
    acts = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(-1, None, "x")], "act_id long, text string, section_number string")
    got = {}
    for r in footnotes.act_footnotes(acts).collect():
        got.setdefault(r.act_id, []).append(tuple(r)[1:])
    for k, text in enumerate(texts):
        assert sorted(got.pop(k, []), key=repr) == plain_footnotes(text), text
    assert not got
    assert footnotes.act_footnotes(acts.limit(0)).count() == 0


def test_structured_footnotes(spark):
    text = "Body.\n[Footnotes]\n1. Subs. by Act 44 of 1991, s. 26, for 'three  years'\n2. This was\n added\n3. Rep. by Act 1 of 1900 for \"x\"\n10. Renumbered.\n11. See above\n"
    rows = spark.createDataFrame([(text,), ("no block",), (None,)], "t string").select(footnotes.structured_footnotes(F.col("t")).alias("f")).collect()
    assert [tuple(x) for x in rows[0].f] == [
        (1, "Subs. by Act 44 of 1991, s. 26, for 'three years'", "substitution", "Act 44 of 1991", "three years"),
        (2, "This was added", "insertion", None, None),
        (3, 'Rep. by Act 1 of 1900 for "x"', "omission", "Act 1 of 1900", "x"),
        (10, "Renumbered.", "renumbering", None, None),
        (11, "See above", "note", None, None),
    ]
    assert rows[1].f == rows[2].f == []


MODERN = (
    "ARRANGEMENT OF SECTIONS\n1. Short title.\n2. Definitions.\nTHE X ACT\nAn Act to do things\n\nPART I\nPreliminary\n\nCHAPTER I\nFirst matters\n\n"
    "**1. Short title and extent.—** (1) This Act may be called X. It has some more words, so that it stays alone.\n"
    "2. Definitions.—In this Act,\n(a) 'a' means b;\n(b) 'c' means d " + "x " * 900 + ";\n(c) 'e' means\n\n" + "y " * 700 + "\n\n" + "z " * 300 + "\n"
    "> 1. Subs. by Act 5 of 2000.\n"
    "3. [Omitted by Act 4 of 1950]\n"
    "CHAPTER II\nMore\n\n"
    "4. Tiny.\n"
    "5A. Powers.--" + "long " * 50 + "\n(1) one " + "w " * 600 + "\n(2) two " + "v " * 300 + "\n"
    "6. Paragraphs\n\n" + "\n\n".join("p" * 500 for _ in range(5)) + "\n\n\n\n" + "q" * 2000 + "\n"
    "THE FIRST SCHEDULE\nForms\n\nForm text of the schedule that is long enough to stay as a provision of its own, surely.\nCHAPTER III\nEnd\n"
)
ROMAN = "I. First thing.—" + "a " * 60 + "\nII. Second\n" + "b " * 160 + "\nIIII. four\nABC. no\nIV. Fourth.-" + "c " * 60


def acts(spark, *texts):
    return spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "act_id long, text string, title string")


def test_boundaries_with_titles_and_context(spark):
    rows = provisions.boundaries(acts(spark, MODERN)).orderBy("char_start").collect()
    assert [(r.type, r.number, r.title, r.chapter, r.part, r.is_repealed) for r in rows] == [
        ("preamble", "", "Preamble", "", "", False),
        ("part_heading", "I", "Preliminary", "", "I", False),
        ("chapter_heading", "I", "First matters", "I", "I", False),
        ("short_title", "1", "Short title and extent", "I", "I", False),
        ("definitions", "2", "Definitions", "I", "I", False),
        ("section", "3", "[Omitted by Act 4 of 1950]\nCHAPTER II\nMore\n\n4. Tiny.\n5A. Powers", "I", "I", True),  # the first dash within reach ends a title
        ("chapter_heading", "II", "More", "II", "I", False),
        ("section", "4", "Tiny.\n5A. Powers", "II", "I", False),
        ("section", "5A", "Powers", "II", "I", False),
        ("section", "6", "Paragraphs", "II", "I", False),
        ("schedule", "1", "Forms", "II", "I", False),
        ("chapter_heading", "III", "End\n".strip(), "III", "I", False),
    ]
    assert rows[4].chapter_title == "First matters" and rows[4].part_title == "Preliminary"
    for r, following in zip(rows, [*rows[1:], None], strict=True):
        assert r.char_end == (following.char_start if following else len(MODERN)) and r.body == MODERN[r.char_start : r.char_end]


def test_roman_sections_of_old_acts_and_acts_without_any(spark):
    rows = provisions.boundaries(acts(spark, ROMAN, "plain words", "", None)).orderBy("act_id", "char_start").collect()
    assert [(r.act_id, r.type, r.number, r.title) for r in rows] == [(0, "section", "I", "First thing"), (0, "section", "II", "Second"), (0, "section", "IIII", "four\nABC. no\nIV. Fourth"), (0, "section", "IV", "Fourth"), (1, "body", "", ""), (2, "body", "", "")]
    assert provisions.boundaries(acts(spark).limit(0)).count() == 0


def plain_merge(rows, least=80):
    out, held = [], None
    for r in rows:
        r = dict(r)
        size = r["char_end"] - r["char_start"]
        if r["type"].endswith("_heading"):
            held = held or r
            held["last_title"], held["end"] = r["title"], r["char_end"]
            continue
        if held:
            r["char_start"] = held["char_start"]
            r["chapter_title"], r["part_title"] = r["chapter_title"] or held["last_title"], r["part_title"] or held["last_title"]
            held = None
        if size < least and out:
            out[-1]["char_end"], out[-1]["priority"] = r["char_end"], max(out[-1]["priority"], r["priority"])
            out[-1]["is_repealed"] &= r["is_repealed"]
        else:
            out.append(r)
    if held and out:
        out[-1]["char_end"] = held["end"]
    elif held:
        out.append(held | {"char_end": held["end"]})
    return [(r["type"], r["number"], r["char_start"], r["char_end"], r["priority"], r["chapter_title"], r["part_title"], r["is_repealed"]) for r in out]


def test_small_provisions_merge_without_losing_text(spark):
    rng = random.Random(4)
    lines = ["CHAPTER {n}\nA title\n\n", "PART {n}\nB\n\n", "{n}. Short.\n", "{n}. A longer one.—" + "w " * 60 + "\n", "{n}. [Repealed by Act 1 of 1900]\n", "An Act to try\n", "SCHEDULE\nS\n\n"]
    texts = [MODERN, ROMAN, "CHAPTER I\nalone\n\n", "PART I\nx\n\nCHAPTER I\ny\n\n"] + ["".join(rng.choice(lines).format(n=rng.randint(1, 30)) for _ in range(rng.randint(1, 12))) for _ in range(80)]
    found = provisions.boundaries(acts(spark, *texts)).cache()
    before, after = {}, {}
    for r in found.orderBy("act_id", "char_start").collect():
        before.setdefault(r.act_id, []).append(r.asDict())
    for r in provisions.merged(found).orderBy("act_id", "char_start").collect():
        after.setdefault(r.act_id, []).append(r)
    for k, text in enumerate(texts):
        rows = after[k]
        if not all(r["type"].endswith("_heading") for r in before[k]):
            assert [(r.type, r.number, r.char_start, r.char_end, r.priority, r.chapter_title, r.part_title, r.is_repealed) for r in rows] == plain_merge(before[k]), text
        assert "".join(r.body for r in rows) == text[before[k][0]["char_start"] :]
        assert all(r.body == text[r.char_start : r.char_end] for r in rows)


def test_large_provisions_split_by_clause_sub_section_and_paragraph(spark):
    rows = provisions.pieces(provisions.merged(provisions.boundaries(acts(spark, MODERN)))).orderBy("char_start").collect()
    assert all(len(r.text) <= 1500 or "\n\n" not in r.text for r in rows)
    assert all(MODERN[r.char_start :].lstrip().startswith(r.text[:400]) for r in rows)
    by = [(r.number, r.sub_section, r.provision_type) for r in rows]
    assert by == [
        ("", "", "preamble"), ("1", "", "short_title"), ("2", "", "section"), ("2", "(a)", "definition_clause"), ("2", "(b)", "definition_clause"), ("2", "(c)", "definition_clause"), ("2", "(c)", "definition_clause"),
        ("5A", "", "section"), ("5A", "(1)", "sub_section"), ("5A", "(2)", "sub_section"), *[("6", "", "section")] * 4, ("1", "", "schedule"),
    ]
    text = "".join("".join(r.text.split()) for r in rows)
    start = min(r.char_start for r in rows)
    assert text == "".join(MODERN[start:].split())


@pytest.mark.parametrize("groups", [0, 1])
def test_places_equal_those_of_python(spark, groups):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab1 \né𝄞") for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["", "1", "11a1"]
    pattern = r"(\d+)[ab]?" if groups else r"[ab]+1"
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", matches.places(F.col("t"), pattern, groups).alias("p")).collect()
    for r in rows:
        assert [tuple(x) for x in r.p] == [(m.start(), m[0], *m.groups()) for m in re.finditer(pattern, texts[r.k])]


def test_found_in_spite_of_white_space(spark):
    cases = [("a b", "x a  b", 0), ("a b", "a b a\n\tb", 1), ("a.b (c", "a.b   (c", 0), ("", "abc", 1), ("zz", "abc", 0), ("a \\E b", "z a\n\\E  b", 0), (None, "a", 0), ("a", None, 0), (" ", "ab", 0), ("é x", "𝄞𝄞é\xa0x", 0)]
    rows = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, needle string, t string, at int")
    got = rows.select("k", matches.find_tolerant(F.col("needle"), F.col("t"), F.col("at")).alias("f")).orderBy("k").collect()
    assert [tuple(r.f) if r.f else None for r in got] == [(2, 6), (4, 8), (0, 8), (1, 1), None, (2, 9), None, None, None, (2, 5)]
    near = rows.filter("k = 0").select(matches.find_tolerant(F.col("needle"), F.col("t"), window=4).alias("f")).first()
    assert near.f is None


def test_spans_are_found_by_characters(spark):
    rows = spark.sql("SELECT array(named_struct('text', 'abc', 'box', 1), named_struct('text', 'd', 'box', 2), named_struct('text', '', 'box', 3), named_struct('text', 'ef', 'box', 4)) AS s")
    index = rows.select(matches.span_index(F.col("s")).alias("i"))
    assert [(x.begin, x.end) for x in index.first().i] == [(0, 3), (5, 6), (8, 8), (10, 12)]
    found = index.select(*(matches.spans_between(F.col("i"), F.lit(a), F.lit(b)).alias(f"f{a}") for a, b in ((2, 6), (3, 5), (11, 99)))).first()
    assert [[x.box for x in f] for f in found] == [[1, 2], [], [4]]
