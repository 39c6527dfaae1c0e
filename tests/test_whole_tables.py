"""The operators with pinned literal cases, as queries over whole tables."""

from docketry.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_texts_of_a_table_are_read(spark, tmp_path):
    head = "WRIT PETITION No. 5 of 2010\nDATE : 1 January 2011\nDivision Bench\nsee 2024:KER:5678.\nThe petition is allowed."
    rows = [(1, "FACTS\nThe brief facts", "en", "a"), (2, head, "en", "b"), (3, "An Act to test a thing.\nPART I \nCHAPTER II \n1. Short title", "en", "c"), (4, "X v. Y", "en", "d"), (5, None, "en", "e")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))

    def run(name):
        return QUERIES[name](spark, str(tmp_path)).collect()

    assert {r.doc_id: r.section_type for r in run("document_section_types")}[1] == "facts"
    assert [tuple(r) for r in run("document_citations")] == [(2, "neutral_hc_colon", "2024:KER:5678")]
    assert [r.raw for r in run("document_citation_keys")] == ["2024:KER:5678"]
    assert {r.doc_id: (r.decision_date, r.case_type, r.case_number, r.disposal_status) for r in run("document_metadata")}[2] == ("2011-01-01", "WRIT PETITION", "5 of 2010", "ALLOWED")
    assert [(r.type, r.number, r.chapter, r.part) for r in run("document_provisions") if r.doc_id == 3][-1] == ("section", "1", "II", "I")
    assert len(run("document_taxonomy")) == len(run("document_parties")) == sum(r.n for r in run("document_dispositions")) == 5


def test_columns_of_the_given_tables_are_read(spark):
    orders = {r.o_orderkey: r.o_orderdate for r in spark.read.parquet(f"{SF}/orders.parquet").collect()}
    assert {r.o_orderkey: r.iso for r in QUERIES["order_dates"](spark, SF).collect()} == {k: f"{d:%Y-%m-%d}" for k, d in orders.items()}
    assert {r.o_orderkey: r.year for r in QUERIES["order_assessment_years"](spark, SF).collect()} == {k: f"{d.year}-{(d.year + 1) % 100:02}" for k, d in orders.items()}
    names = {r.c_custkey: r.c_name for r in spark.read.parquet(f"{SF}/customer.parquet").collect()}
    assert {r.c_custkey: (r.party, r.city) for r in QUERIES["customer_parties"](spark, SF).collect()} == {k: (n, "") for k, n in names.items()}
    assert {(r.c_custkey, r.court, r.slug) for r in QUERIES["customer_court_names"](spark, SF).collect()} == {(k, None, None) for k in names}
