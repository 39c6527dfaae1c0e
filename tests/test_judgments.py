"""Metadata of judgments: each rule on a text that it is for, and on none."""

import pytest
from pyspark.sql import functions as F

from docketry.functions import judgments as j


def each(spark, values, f):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.x for r in rows.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


def test_decision_dates(spark):
    cases = {
        "DATE : 3rd March 2019": "2019-03-03",
        "DATED : 5.7.49": "2049-07-05",
        "DATED : 5/7/50": "1950-07-05",
        "Dated: March 12, 2001": "2001-03-12",
        "decided on 31 Feb 2000": "2000-02-31",
        "heard 04.05.2015 in court": "2015-05-04",
        "DATE : 3rd Foo 2019 but on 4th May 2018": "2018-05-04",
        "no date": None,
        "": None,
    }
    assert each(spark, [*cases, None], j.decision_date) == [*cases.values(), None]


def test_types_numbers_benches_outcomes(spark):
    assert each(spark, ["WRIT PETITION (CIVIL)", "Cr.A. 5", "PIL", "SLP 3", "x", None], j.case_type) == ["WRIT PETITION", "CRIMINAL APPEAL", "PIL", "SPECIAL LEAVE PETITION", None, None]
    assert each(spark, ["Case No. 12/3 of 2001", "Civil Appeal No. 7 of 1999", "No: 8 / 2003", "x"], j.case_number) == ["12/3 of 2001", "7 of 1999", "8 of 2003", None]
    assert each(spark, ["a Division Bench", "the DB of", "db", None], j.bench_type) == ["DIVISION BENCH", "DIVISION BENCH", None, None]
    assert each(spark, ["the appeal is Dismissed", "disposed off", "x", None], j.outcome) == ["DISMISSED", "DISPOSED", None, None]
    assert each(spark, ["ANTICIPATORY BAIL", "REVISIONAL JURISDICTION", "x"], lambda t: j.jurisdiction(t, F.lit("PIL"))) == ["CRIMINAL", "REVISIONAL", "WRIT"]


def test_what_is_cited(spark):
    text = "under Section 302 of the Indian Penal Code, 1860 and section 302 of the INDIAN PENAL CODE, 1860; Article 21 of the Constitution, Article 21 of the Constitution"
    (got,) = each(spark, [text], j.acts_cited)
    assert [(a.section, a.act) for a in got] == [("302", "Indian Penal Code, 1860")]
    assert each(spark, [text, "", None], j.articles_cited) == [["Article 21"], [], None]


def test_metadata_of_a_whole_text(spark):
    text = "WRIT PETITION No. 5 of 2010\nDATE : 1 January 2011\n" + "words " * 3000 + "the petition is allowed."
    got, empty, none = each(spark, [text, "", None], j.metadata)
    assert (got.decision_date, got.case_type, got.case_number, got.jurisdiction, got.disposal_status) == ("2011-01-01", "WRIT PETITION", "5 of 2010", "WRIT", "ALLOWED")
    for r in (empty, none):
        assert r.decision_date is r.case_type is r.case_number is r.jurisdiction is r.disposal_status is None


@pytest.mark.parametrize(("court", "expected"), [("high_court", [False, False, True, True, False, False, False]), ("supreme_court", [True, False, True, True, False, False, False])])
def test_names_of_judges(spark, court, expected):
    names = ["kumar", "Therefore", "A. Rao", "justice x", "12345", "High Court of", None]
    assert each(spark, names, lambda t: j.is_judge(t, F.lit(court))) == expected


def test_dispositions(spark):
    cases = {
        " disposed off no costs": "DISPOSED OF", "Partly Allowed": "PARTLY ALLOWED", "case allowed": "ALLOWED", "DISMISED AS INFRACTOUS": "DISMISSED AS INFRUCTUOUS",
        "Dismissed for non prosecution": "DISMISSED FOR DEFAULT", "DISMISSED AS WITHDRAWN": "WITHDRAWN", "DISMISS": "DISMISSED", "NOT-PRESSED": "WITHDRAWN",
        "ANTICIPATORY BAIL REJECTED": "BAIL GRANTED", "BAIL CANCELLED": "BAIL REJECTED", "RULE MADE ABSOLUTE": "RULE MADE ABSOLUTE", "REVERSED": "SET ASIDE",
        "38-RULE ABSOLUTE/ALLOWED": None, "ALLOWED @ FH": None, "HEARD": None, "ALLOWED" + " x" * 30: None, "DELAY CONDONED": None, "": None,
    }
    assert each(spark, [*cases, None], j.disposition) == [*cases.values(), None]


def test_courts(spark):
    assert each(spark, ["HCMD0100", "PHHC1", "XXXX", None], j.court_name) == ["Madras High Court", "Punjab and Haryana High Court", None, None]
    assert each(spark, ["Punjab and Haryana High Court"], j.court_slug) == ["punjab-and-haryana"]
