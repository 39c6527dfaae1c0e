"""Tribunal records: each rule on records that it is for."""

import json

import pytest
from pyspark.sql import functions as F

from docketry.sources import tribunals as t

ITAT = t.Tribunal("itat", "Income Tax Tribunal", "itat", {"petitioner": "appellant", "decision_date": "order_date", "case_number": "appeal_no", "judges": "members", "pdf_url": "pdf"}, ("assessment_year",), judgment=("equals", "kind", "Order"))
NCLT = t.Tribunal("nclt", "Company Tribunal", "nclt", {"bench": "bench_location", "case_type": "case_type_desc"}, judgment=("contains", "_path", "orders, cases"))
SAT = t.Tribunal("sat", "Securities Tribunal", "sat", judgment=("not_empty", "appeal_type", ""))
CAT = t.Tribunal("cat", "Administrative Tribunal", "cat", {"pdf_url": "url"}, judgment=("contains", "title", "JUDGMENT"))
APTEL = t.Tribunal("aptel", "Electricity Tribunal", "aptel")


def run(spark, tribunal, *records, source="/raw/ahmedabad-cases.jsonl"):
    lines = spark.createDataFrame([(json.dumps(r) if isinstance(r, dict) else r, source) for r in records], "line string, source_file string")
    good, _ = t.parsed(lines)
    found = t.normalized(good, tribunal)
    return [r.asDict() | {"raw": json.loads(r.raw)} for r in found.withColumn("raw", F.to_json("raw_metadata")).drop("raw_metadata").collect()]


def test_income_tax_records(spark):
    (r,) = run(spark, ITAT, {"appellant": "<b>ATUL MARDIA</b>,NEW DELHI", "respondent": "ITO, Nowhere", "order_date": "05/03/2019", "appeal_no": "ITA 12/Del/2018", "members": ["A Rao", " ", "<i>B</i> Sen"], "pdf": ["http://x/1", "http://x/2"],
                             "assessment_year": "2012-2013", "kind": "order", "pdf_filename": "a.pdf", "odd": {"n": 1}, "none": None, "bench": "Delhi Bench"})
    assert (r["petitioner"], r["petitioner_city"], r["respondent"], r["respondent_city"]) == ("ATUL MARDIA", "New Delhi", "ITO, Nowhere", None)
    assert (r["case_id"], r["decision_date"], r["year"], r["bench"], r["judges"]) == ("ITAT_ITA12DEL2018", "2019-03-05 00:00:00", 2019, "itat_delhi", ["A Rao", "B Sen"])
    assert (r["pdf_url"], r["source_pdf_url"], r["assessment_year"], r["is_judgment"]) == ("local://itat/pdfs/a.pdf", "http://x/1", "2012-13", True)
    assert r["raw"] == {"respondent": "ITO, Nowhere", "kind": "order", "pdf_filename": "a.pdf", "odd": {"n": 1}, "bench": "Delhi Bench"}
    assert r["title"] == "ATUL MARDIA Vs ITO, Nowhere [ITA 12/Del/2018] (2019)"


def test_nested_results_are_promoted_where_fields_are_absent(spark):
    record = {"pdf_url": "http://x", "case_no": "own/1", "search_result": {"case_no": "inner", "case_title1": "A Ltd", "case_title2": "B Ltd", "disposal_date": "2020-01-02", "bench_location_name": "Ahmedabad", "status": None}}
    (r,) = run(spark, NCLT, record)
    assert (r["case_number"], r["petitioner"], r["respondent"], r["decision_date"], r["bench"]) == ("own/1", "A Ltd", "B Ltd", "2020-01-02 00:00:00", "nclt_ahmedabad")
    assert (r["pdf_url"], r["source_pdf_url"], r["is_judgment"]) == ("local://nclt/pdfs/ahmedabad/own_1.pdf", "http://x", True)
    assert r["raw"] == {"pdf_url": "http://x", "sr_case_no": "inner", "sr_case_title1": "A Ltd", "sr_case_title2": "B Ltd", "sr_disposal_date": "2020-01-02", "sr_bench_location_name": "Ahmedabad"}
    (flat,) = run(spark, NCLT, {"pdf_url": "u", "search_result": "no object", "case_title1": "C"})
    assert (flat["petitioner"], flat["pdf_url"]) == ("C", "u") and "sr_case_no" not in flat["raw"]


def test_records_without_a_file_and_lines_without_a_record_go(spark):
    lines = spark.createDataFrame([("{}", "s"), ("[1]", "s"), ("bad", "s"), ("", "s"), (None, "s"), ('{"pdf_url": []}', "s"), ('{"pdf_url": "", "has_pdf": true, "pdf_filename": "x.pdf"}', "s"), ('{"pdf_filename": "f"}', "s")], "line string, source_file string")
    good, bad = t.parsed(lines)
    assert sorted(r.line for r in bad.collect()) == ["[1]", "bad"]
    got = {r.pdf_url for r in t.normalized(good, t.Tribunal("rera_maharera", "R", "rera")).collect()}
    assert got == {"local://rera-maharera/pdfs/x.pdf", None}
    assert t.normalized(good.limit(0), SAT).count() == 0


def test_paths_numbers_and_years(spark):
    (sat,) = run(spark, SAT, {"pdf_filename": "a.pdf", "appeal_type": "Appeal", "year": 2011, "country": "india"})
    assert (sat["pdf_url"], sat["source_pdf_url"], sat["year"], sat["country_code"], sat["is_judgment"]) == ("local://sat/pdfs/appeal/a.pdf", "local://sat/pdfs/appeal/a.pdf", 2011, "IN", True)
    assert sat["case_id"].startswith("SAT_") and len(sat["case_id"]) == 16 and sat["title"] == "(2011)"
    one, two = run(spark, CAT, {"url": "u", "case_number": 5, "bench": "Delhi", "case_year": "2001-02", "title": "a Judgment"}, {"url": "u", "case_number": 5, "bench": "Delhi", "case_year": "2002", "title": "x"})
    import hashlib

    context = json.dumps({"petitioner": "", "date": None, "bench": "cat_delhi", "case_type": None, "year": 2001}, sort_keys=True)
    assert one["case_id"] == "CAT_5_" + hashlib.md5(context.encode()).hexdigest()[:8] != two["case_id"]
    assert (one["case_number"], one["is_judgment"], two["is_judgment"]) == ("5", True, False)
    (aptel,) = run(spark, APTEL, {"title": "Power Co v. State Board", "pdf_filenames": ["x.pdf", "y.pdf"], "pdf_url": "u", "year": "2015", "decision_date": "2014-01-01"})
    assert (aptel["petitioner"], aptel["respondent"], aptel["pdf_url"], aptel["year"]) == ("Power Co", "State Board", "local://aptel/pdfs/2015/x.pdf", 2015)


def test_all_tribunals_together(spark):
    lines = spark.createDataFrame([('{"pdf_url": "u", "assessment_year": "2001-02"}', "s")], "line string, source_file string")
    good, _ = t.parsed(lines)
    whole = t.union([t.normalized(good, x) for x in (ITAT, SAT, CAT)])
    assert whole.columns[: len(t.COMMON)] == t.COMMON and {r.tribunal: r.assessment_year for r in whole.collect()} == {"sat": None}
    with pytest.raises(ValueError, match="rule"):
        t.is_judgment(F.lit(None), F.lit(""), ("sometimes", "x", ""))
