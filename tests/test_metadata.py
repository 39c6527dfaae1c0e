"""Metadata from several sources, registry rows as chunk metadata, and chunks as rows of cases."""

from pyspark.sql import functions as F

from docketry.operators import metadata


def test_the_first_source_with_a_valid_value_wins(spark):
    cases = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "cnr string")
    registry = spark.createDataFrame([("a", "X Vs Y", " ", "Kerala High Court", ["R"], 5), ("b", None, "d", "", [], 0)], "cnr string, title string, description string, court string, judges array<string>, n int")
    text = spark.createDataFrame([("a", "heading a", "text d", "Court", [], 7, "P"), ("b", "heading b", "x", "Court b", ["S", "T"], 8, "")], "cnr string, heading string, description string, court string, judges array<string>, n int, petitioner string")
    title = registry.select("cnr", metadata.from_title(F.col("title")).alias("s")).select("cnr", "s.*")
    rules = [*metadata.CASE_RULES, metadata.Rule("n", [("registry", "n"), ("text", "n")]), metadata.Rule("big", [("registry", "n"), ("text", "n")], lambda v: v > 6), metadata.Rule("odd", [("nowhere", "x"), ("text", "missing")])]
    got = {r.cnr: r for r in metadata.merged(cases, {"registry": registry, "text": text, "title": title}, rules, "cnr").collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.title, a.description, a.court, a.judges, a.petitioner, a.respondent, a.n, a.big, a.odd) == ("X Vs Y", "text d", "Kerala High Court", ["R"], "P", "Y", 5, 7, None)
    assert a.won == {"title": "registry", "description": "text", "court": "registry", "judges": "registry", "petitioner": "text", "respondent": "title", "n": "registry", "big": "text"}
    assert (b.title, b.description, b.court, b.judges, b.petitioner, b.n) == ("heading b", "d", "Court b", ["S", "T"], None, 8)
    assert c.won == {} and c.title is None and len(got) == 3


def test_registry_rows_become_chunk_metadata(spark):
    registry = spark.createDataFrame([("k1", "A v B Vs. C Ltd", "P. Rao, Q Sen & R", "01-02-2003", "Dismissed", None, None, "text"), ("k2", "In re D", None, None, None, "Kerala High Court", "d", None)], "cnr string, title string, judge string, decision_date string, disposal_nature string, court string, date_of_registration string, description string")
    files = spark.createDataFrame([("k1", 1999, "taphc", "27_1", "http://x")], "cnr string, year int, bench string, court_code string, pdf_url string")
    one, two = metadata.registry_rows(registry, files, {"taphc": "Telangana Bench"}).orderBy("case_id").collect()
    assert (one.petitioner, one.respondent, one.judges, one.year, one.court, one.bench_display_name, one.state_code, one.establishment_code) == ("A v B", "C Ltd", ["P. Rao", "Q Sen", "R"], 2003, "High Court", "Telangana Bench", "27", "1")
    assert (two.petitioner, two.judges, two.year, two.decision_date, two.pdf_url, two.court) == ("", [], 0, "", "", "Kerala High Court")


def test_first_chunks_become_rows_of_cases(spark):
    schema = "case_id string, title string, court string, court_type string, citation string, bench_strength int, judges array<string>, decision_date string, disposition string, petitioner string, respondent string, year int"
    rows = [("c1", "T" * 300, "High Court of Kerala", None, "", 0, ["a", "b"], "05-03-2001 00:00:00", "Disposed Off", "P", None, 2001), ("c2", None, "Supreme Court of India", None, "AIR 1", 3, None, "2001-03-05", "odd", None, None, None), ("", None, None, None, None, None, None, None, None, None, None, None)]
    one, two = metadata.case_rows(spark.createDataFrame(rows, schema)).orderBy("corpus_case_id").collect()
    assert (one.primary_citation, one.decision_date, one.bench_strength, one.judges, one.court_normalized, one.court_type, one.disposition_normalized, len(one.snippet)) == ("HC-c1", "2001-03-05", 2, '["a","b"]', "Kerala High Court", "high_court", "DISPOSED OF", 200)
    assert (two.primary_citation, two.decision_date, two.bench_strength, two.judges, two.court_type, two.disposition_normalized, two.snippet) == ("AIR 1", "2001-03-05", 3, None, "supreme_court", None, None)
