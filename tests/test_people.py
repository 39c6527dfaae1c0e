"""Judges, parties and advocates of judgments in the shapes that courts write them."""

import pytest
from pyspark.sql import functions as F

from docketry.functions import judgments, people

HEADS = {
    "lines": "IN THE HIGH COURT OF KERALA AT ERNAKULAM\nPRESENT\nCriminal Appeal No. 5 of 2001\n1. Raman Nair, aged 50 ...Petitioner\n---\nVersus\n---\n& Ors.\n1. State of Kerala ....Respondent\nMr. X for the respondent",
    "dots": "Some Court\nAnita Rao .... Versus .... Union of India and another\n",
    "inline": "In the matter\nBharat Ltd. v. State Bank of India\nORDER",
    "markup": "## Case\n**Sita Devi** ... Appellant\nV/s\n| Municipal Board : Respondent\n",
    "none": "nothing parts anybody here",
    "cleaned": "Asha Traders -vs- Commissioner of Customs",
    "roles": "Petitioner\nVersus\nRespondent\n",
}


def parties(spark, texts):
    rows = spark.createDataFrame(list(texts.items()), "k string, t string")
    got = rows.select("k", people.parties(F.col("t"), judgments.head(F.col("t"))).alias("p")).collect()
    return {r.k: tuple(r.p) for r in got}


def test_parties_are_the_nearest_valid_lines(spark):
    got = parties(spark, HEADS | {"null": None, "empty": ""})
    assert got == {
        "lines": ("Raman Nair, aged 50", "State of Kerala"),
        "dots": ("Anita Rao", "Union of India and another"),
        "inline": ("Bharat Ltd", "State Bank of India"),
        "markup": ("Sita Devi", "Municipal Board"),
        "none": (None, None),
        "cleaned": ("Asha Traders", "Commissioner of Customs"),
        "roles": (None, None),
        "null": (None, None),
        "empty": (None, None),
    }


def test_lines_further_than_the_window_are_no_parties(spark):
    far = "Far Away Person\n" + "-\n" * 800 + "Versus\n" + "-\n" * 800 + "Another Person\n"
    assert parties(spark, {"far": far})["far"] == (None, None)


@pytest.mark.parametrize(
    ("head", "names"),
    [
        ("CORAM : HON'BLE MR. JUSTICE A. K. RAO AND HON'BLE MS. JUSTICE B. SEN DATE : 1ST MAY 2001", ["A. K. RAO", "B. SEN"]),
        ("BENCH : P. Nair, J. & Q. Das JUDGMENT", ["P. Nair", "Q. Das"]),
        ("Before the learned judge ORDER HON'BLE JUSTICE R. MENON", ["R. MENON"]),
        ("HON'BLE MR. JUSTICE S. GUPTA DATED", ["S. GUPTA"]),
        ("Division Bench sat", []),
        ("it was so held (T. U. VERMA, J.)", ["T. U. VERMA"]),
        ("CORAM : this court ORDER", []),
        ("", []),
        (None, []),
    ],
)
def test_judges(spark, head, names):
    row = spark.createDataFrame([(head,)], "h string").select(people.judges(F.col("h")).alias("j")).first()
    assert row.j == names


@pytest.mark.parametrize(
    ("head", "petitioner", "respondent"),
    [
        ("For Petitioner: Mr. R.K. Sharma, Advocate. For the State: Smt. Leela Rao, Advocate", ["R.K. Sharma"], ["Leela Rao"]),
        ("Mr. Anil Dave, learned counsel for the petitioner. Ms. Rita Shah appearing for the respondent", ["Anil Dave"], ["Rita Shah"]),
        ("Public Prosecutor: Shri Mohan Lal", [], ["Mohan Lal"]),
        ("no names", [], []),
    ],
)
def test_advocates(spark, head, petitioner, respondent):
    row = spark.createDataFrame([(head,)], "h string").select(people.advocates(F.col("h")).alias("a")).first()
    assert (row.a.petitioner_advocates, row.a.respondent_advocates) == (petitioner, respondent)


def test_courts_below_reports_headnotes_and_courts(spark):
    text = "appeal against the order of the learned District and Sessions Judge, Kollam. FIR No. 12/2003 of 2004. HEADNOTE: " + "word " * 30 + "\n\nend"
    frame = spark.createDataFrame([(text, "IN THE HIGH COURT OF JUDICATURE AT BOMBAY"), ("judgment of this court, Crime No. 7", "Patna High Court"), ("P.S. Case No. 45 of 2010", "NOWHERE HIGH COURT"), (None, None)], "t string, h string")
    rows = frame.select(*(f(F.col(c)).alias(f.__name__) for f, c in ((people.lower_court, "t"), (people.first_report, "t"), (people.headnote, "t"), (people.court_of_header, "h")))).collect()
    assert [tuple(r) for r in rows] == [
        ("District and Sessions Judge", "12/2003/2004", ("word " * 30).strip(), "High Court of Bombay"),
        (None, "7", None, "High Court of Patna"),
        (None, "45/2010", None, None),
        (None, None, None, None),
    ]


def test_names_and_prose(spark):
    cases = {"A. K. Rao": True, "the": False, "12345": False, "learned counsel for the petitioner": False, "and others": False, "Smith of": False, "some more lower words here": False, "ab": False, "Ram": True, "": False, None: False}
    rows = spark.createDataFrame([(c,) for c in cases], "n string").select("n", people.is_name(F.col("n")).alias("ok")).collect()
    assert {r.n: r.ok for r in rows} == cases
