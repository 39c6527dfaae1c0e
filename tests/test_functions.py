"""Functions against the pinned cases of the published rules."""

import pytest
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions import classify, extract, redaction, text
from docketry.operators import chunking, joins


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize(
    ("before", "after", "counts"),
    [
        ("child in conflict with law namely Ajay Murmu was produced", "child in conflict with law namely [REDACTED] was produced", {"protected_child_named": 1}),
        ("lodged by mother of the prosecutrix namely Smt. Meena Singh on 3.4.2019", "lodged by mother of the prosecutrix namely [REDACTED] on 3.4.2019", {"victim_relative_named": 1}),
        ("APHC010572462018 filed under FIR No.RC023201850012", "APHC010572462018 filed under FIR No.RC023201850012", {}),
        ("CONTACT-9447091300.", "CONTACT-[REDACTED].", {"phone": 1}),
        ("Pin 495449", "Pin 495449", {}),
        ("his PAN is ABCDE1234F and again FGHIJ5678K", "his PAN is [REDACTED] and again [REDACTED]", {"pan": 2}),
        ("case ABCDE1234F of 2019", "case ABCDE1234F of 2019", {}),
        ("account number at SBIN0001234", "account number at [REDACTED]", {"ifsc": 1}),
        ("write to a.b@c-d.org", "write to [REDACTED]", {"email": 1}),
        ("Aadhaar 2341 2341 2346 given", "Aadhaar [REDACTED] given", {"aadhaar": 1}),
        ("Aadhaar 1234 5678 9012 given", "Aadhaar 1234 5678 9012 given", {}),
        (None, None, {}),
    ],
)
def test_redaction(spark, before, after, counts):
    got = one(spark, before, redaction.redact)
    assert (got.text, got.counts or {}) == (after, counts)


@pytest.mark.parametrize(
    ("t", "gone"),
    [("the matter was heard in camera as directed", True), ("the trial was not in camera", False), ("it was never in camera", False), ("ordinary civil appeal against the decree", False), ("see MANU/TN/1707/2010 in SCC OnLine", False), ("Cite this article", True), (None, False)],
)
def test_exclusion(spark, t, gone):
    assert one(spark, t, redaction.excluded) is gone


@pytest.mark.parametrize(
    ("t", "kind"),
    [("RATIO DECIDENDI\nThe court", "ratio_decidendi"), ("ISSUES\n1. Whether", "issues"), ("1. The appellant", "paragraph"), ("Some random legal text", "body"), ("it is our view that THE RATIO is", "ratio_decidendi"), ("", "body"), (None, "body")],
)
def test_section_types(spark, t, kind):
    assert one(spark, t, classify.section_type) == kind


def test_provisions_of_text(spark):
    assert one(spark, "Notwithstanding anything contained in this Act he shall not", classify.provision_type) == "overriding"
    assert one(spark, "[Omitted by Act 5]", classify.section_status) == "omitted"
    assert one(spark, "may, by notification in the Gazette, make rules", lambda t: classify.delegation_type(t, F.lit("7"))) == "rules"
    assert one(spark, "may make rules", lambda t: classify.delegation_type(t, F.lit("1"))) is None
    assert one(spark, "The Income-tax and Banking Act", classify.legal_subjects) == ["tax_law", "banking_finance"]
    got = one(spark, "shall be punishable with imprisonment for a term which may extend to 3 years, or fine of rupees 5 lakh.", extract.penalties)
    assert (got.imprisonment, got.fine) == (["3 years"], ["5 lakh"])
    assert one(spark, "nothing", extract.penalties) is None
    assert one(spark, "see section 41, Section 2(d), section 41 and First Schedule", lambda t: extract.internal_references(t, F.lit("41"))) == ["2(d)", "First Schedule"]


def test_languages(spark):
    assert one(spark, "the court of the state shall order that the petition is " * 5, classify.language_class) == "english"
    assert one(spark, "यह एक हिंदी वाक्य है " * 20, classify.language_class) == "hindi_unicode"
    assert one(spark, "vkoS dk;Z djus tkrk gksxk xyz qwv " * 20, classify.legacy_font_class) == "krutidev_gibberish"
    assert one(spark, "short", classify.language_class) == "empty"


def test_titles_and_fields(spark):
    assert one(spark, "color='black'>A <b>B</b>  Additional Party(Pet.):", text.clean_field) == "A B"
    assert one(spark, "Hon'ble Principal Bench, New Delhi", lambda t: text.bench_slug("cat", t)) == "cat_new_delhi"
    assert one(spark, "<p>a<br>b &amp; c<sup>3</sup></p>", text.html_to_text) == "a\nb & c[3]"
    assert one(spark, "A. Rao, B. Sen and C", extract.judges) == ["A. Rao", "B. Sen and C"]
    assert one(spark, "X", lambda t: extract.case_title(F.lit("12"), t, F.lit(None).cast("string"), F.lit(2020))) == "X [12] (2020)"
    assert one(spark, "X", lambda t: extract.case_header(t, F.lit("AIR 1"), F.lit(2020), F.lit("facts"), F.lit("High Court"))) == "Case: X [AIR 1] (2020)\nCourt: High Court\nSection: FACTS\n\n"
    assert one(spark, "12-03-2020 x", extract.day_first_to_iso) == "2020-03-12"


def test_boxes(spark):
    rows = spark.createDataFrame([([("page-header", "H"), ("title", "T"), ("text", "x"), ("section-header", "S")],)], "boxes array<struct<box_class:string,text:string>>")
    assert rows.select(text.text_of_boxes(F.col("boxes")).alias("x")).first().x == "[TITLE] # T\n\nx\n\n[SECTION] ## S"


def test_repeated_page_edges(spark):
    pages = spark.createDataFrame([(1, k, f"High Court\nbody {k}\nmore {k}\nlast {k}") for k in range(5)], "doc_id long, page_number int, text string")
    assert [tuple(r) for r in text.repeated_edges(pages).collect()] == [(1, "High Court")]


def test_unknown_status_is_an_error(spark):
    rows = spark.createDataFrame([("state", "state", "Kerala", "odd")], "jurisdiction string, category string, state string, act_status string")
    with pytest.raises(Exception, match="unknown act_status"):
        schemas.taxonomy(rows).collect()


def test_published_coercions(spark):
    raw = spark.createDataFrame([("c", "12", "x", '["a","b"]', "false", "k")], "case_id string, year string, chunk_index string, judges string, box_aware string, r2_key string")
    got = schemas.as_published(raw, schemas.CASE_LAW)
    assert got.columns == schemas.CASE_LAW
    r = got.first()
    assert (r.year, r.chunk_index, r.judges, r.box_aware, r.title) == (12, None, ["a", "b"], True, None)


def test_chunks_cover_the_text(spark):
    body = "\n\n".join(f"Paragraph {k}. " + "words go on and on. " * 30 for k in range(30))
    docs = spark.createDataFrame([(1, body), (2, ""), (3, None), (4, "x" * 9000), (5, "tiny")], "doc_id long, text string")
    rows = chunking.chunk(docs).collect()
    assert {r.doc_id for r in rows} == {1, 4}
    for r in rows:
        source = {1: body, 4: "x" * 9000}[r.doc_id]
        assert source[r.char_start : r.char_end] == r.text_original and len(r.text_original) <= chunking.SIZE
    mine = sorted((r.char_start, r.char_end) for r in rows if r.doc_id == 1)
    assert mine[0][0] == 0 and mine[-1][1] == len(body.strip()) and all(b[0] <= a[1] + 2 for a, b in zip(mine, mine[1:], strict=False))


def test_ids_used_again_get_suffixes(spark):
    rows = spark.createDataFrame([("a", "s1", 0), ("a", "s1", 1), ("a", "s2", 2), ("b", "s1", 0)], "act_id string, base string, i int")
    assert sorted(r.chunk_id for r in chunking.unique_ids(rows, "act_id", "base", "i").collect()) == ["s1", "s1", "s1_d1", "s2"]


def test_pages_of_spans(spark):
    rows = spark.sql("select array(named_struct('page_number', 1, 'char_start', 0, 'char_end', 10), named_struct('page_number', 2, 'char_start', 12, 'char_end', 20)) as p")
    got = rows.select(joins.pages_of_span(F.col("p"), F.lit(5), F.lit(13)).alias("x"), joins.pages_of_span(F.col("p"), F.lit(10), F.lit(12)).alias("y")).first()
    assert tuple(got.x) == (1, 2) and tuple(got.y) == (None, None)
