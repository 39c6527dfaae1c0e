"""What acts and sections say of themselves."""

from pyspark.sql import functions as F

from docketry.functions import legislation as g

ACT = """THE FIRE ACT, 1999
ACT NO. 45 OF 1999
[30th November, 1999]
An Act to provide for fires.
Be it enacted by Parliament as follows.
Ministry of Home Affairs, New Delhi. Published in the Gazette of India, Part II.
1. It extends to the State of Kerala and shall come into force on the 1st day of May, 2000.
2. [Ins. by Act 44 of 2001, s. 26] See the Indian Penal Code, 1860 and Water Act 1974, and the Indian Penal Code, 1860.
3. The Smoke Regulation, 1806 is repealed. This repeals the Old Fire Act, 1901.
1. Subs. by Act 5 of 2002, s. 3 (w.e.f. 1-1-2003).
"""
SECTION = """2. "Board" means a board; “Authority” means x; "board" means y. No person shall act; shall be punished with imprisonment for a term which may extend to 3 years.
Provided that an appeal is made within a period of 30 days, or within 2 months, as (2013) 8 SCC 519 and AIR 2005 SC 38 say (see section 41). The Central Government may make rules.
[Footnotes]
1. Added by Act 1 of 2000
"""


def test_acts(spark):
    rows = spark.createDataFrame([(0, ACT), (1, ""), (2, None)], "k int, t string").select("k", g.act_metadata(F.col("t")).alias("m")).orderBy("k").collect()
    m = rows[0].m
    assert (m.territorial_extent, m.commencement, m.act_number, m.act_year) == ("the State of Kerala and shall come into force on the 1st day of May", "the 1st day of May, 2000", "45", 1999)
    assert (m.enacting.date_of_assent, m.enacting.ministry, m.enacting.long_title, m.enacting.enacting_formula) == ("30th November, 1999", "Home Affairs", "An Act to provide for fires.", "Be it enacted by Parliament as follows.")
    assert m.gazette == "Gazette of India, Part II." and m.repeals == ["Old Fire Act, 1901"]
    assert m.acts_referenced == ["Indian Penal Code, 1860", "Water Act 1974", "Old Fire Act, 1901"]
    assert m.amendment_notes == ["Ins. by Act 44 of 2001, s. 26", "Subs. by Act 5 of 2002, s. 3 (w"]
    for r in rows[1:]:
        assert r.m.territorial_extent is r.m.act_number is r.m.enacting.long_title is None and r.m.repeals == r.m.acts_referenced == r.m.amendment_notes == []


def test_sections(spark):
    frame = spark.createDataFrame([(SECTION, "definitions", "2"), (SECTION, "section", "41"), (None, "section", None)], "t string, k string, n string")
    defined, plain, empty = (r.m for r in frame.select(g.section_metadata(F.col("t"), F.col("k"), F.col("n")).alias("m")).collect())
    assert defined.defined_terms == ["authority", "board"] and plain.defined_terms == []
    assert defined.limitation_periods == ["30 days", "2 months"] and defined.case_citations == ["(2013) 8 SCC 519", "AIR 2005 SC 38"]
    assert (defined.sections_referenced, plain.sections_referenced) == (["41"], [])
    assert defined.penalty.imprisonment == ["3 years"] and defined.markers.has_proviso and defined.provision_type == "prohibitory"
    assert [(f.id, f.type) for f in defined.footnotes] == [(1, "insertion")] and defined.amendment_count == 0  # no dot behind Added
    assert empty.amendment_count == 0 and empty.penalty is None and empty.footnotes == []


def test_headers_of_provisions(spark):
    rows = [("The IPC", 1860, "central", "45", "in_force", "XVI", "Offences", "302", "Murder", "(1)"), ("X", 1900, "", None, "", "II", "", "", "T", ""), ("Y", 0, None, "5", None, "", "C", "3A", "", None)]
    names = ["title", "year", "category", "act_number", "status", "chapter", "chapter_title", "number", "section_title", "sub_section"]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n == 'year' else 'string'}" for n in names))
    assert [r.h for r in frame.select(g.provision_header(*(F.col(n) for n in names)).alias("h")).collect()] == [
        "Act: The IPC (Act 45 of 1860) | India | Central | In Force\nChapter XVI: Offences | Section 302(1): Murder",
        "Act: X (1900) | India\nChapter II",
        "Act: Y | India\nSection 3A",
    ]
