"""Registered queries of judgments and tribunal records built of a table's columns, which say what must be found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, judgments
from ..operators import audit, graph, metadata
from ..sources import sinks, tribunals
from .queries import query, spread, table


@query("""
WITH t AS (SELECT c_custkey, c_custkey % 3 < 2 AS said, replace(c_name, '#', '') AS name, c_mktsegment AS seg, c_custkey % 500 + 1 AS n, 1990 + c_nationkey AS y FROM customer)
SELECT c_custkey, CASE WHEN said THEN y || '-03-05' END AS decision_date, CASE WHEN said THEN [seg || ' RAO', 'MEERA ' || seg] ELSE []::VARCHAR[] END AS judges, CASE WHEN said THEN 2 ELSE 0 END AS bench_strength,
  CASE WHEN said THEN name END AS petitioner, CASE WHEN said THEN 'State of ' || seg END AS respondent, CASE WHEN said THEN ['Anil ' || seg] ELSE []::VARCHAR[] END AS petitioner_advocates,
  CASE WHEN said THEN ['Rita ' || seg] ELSE []::VARCHAR[] END AS respondent_advocates, CASE WHEN said THEN 'High Court of Bombay' END AS court, CASE WHEN said THEN 'District Judge' END AS lower_court,
  CASE WHEN said THEN n || '/' || y END AS first_report, CASE WHEN said THEN [n || '|Indian ' || seg || ' Act'] ELSE []::VARCHAR[] END AS acts_cited FROM t""")
def judgment_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who judges, asks, answers and pleads in judgments of customers; a third of the texts say nothing."""
    seg, n, y = F.col("c_mktsegment"), (F.col("c_custkey") % 500 + 1).cast("string"), (1990 + F.col("c_nationkey")).cast("string")
    said = F.concat(
        F.lit("IN THE HIGH COURT OF JUDICATURE AT BOMBAY\nCORAM : HON'BLE MR. JUSTICE "), seg, F.lit(" RAO AND HON'BLE MS. JUSTICE MEERA "), seg, F.lit("\nDATE : 5th March "), y, F.lit("\n1. "), F.col("c_name"),
        F.lit(" ...Petitioner\n---\nVersus\n---\nState of "), seg, F.lit(" ....Respondent\nFor Petitioner: Mr. Anil "), seg, F.lit(", Advocate. For Respondent: Ms. Rita "), seg,
        F.lit(", Advocate.\nAppeal against the order of the District Judge. FIR No. "), n, F.lit(" of "), y, F.lit(" under Section "), n, F.lit(" of the Indian "), seg, F.lit(" Act."),
    )
    texts = spread(table(spark, sf_dir, "customer")).select("c_custkey", F.when(F.col("c_custkey") % 3 < 2, said).otherwise(seg).alias("t"))
    found = texts.select("c_custkey", judgments.full_metadata(F.col("t")).alias("m"))
    return found.select("c_custkey", *(F.col("m")[c].alias(c) for c in ("decision_date", "judges", "bench_strength", "petitioner", "respondent", "petitioner_advocates", "respondent_advocates", "court", "lower_court", "first_report")), F.transform("m.acts_cited", lambda a: F.concat_ws("|", a["section"], a["act"])).alias("acts_cited"))


_ITAT = tribunals.Tribunal("itat", "Income Tax Appellate Tribunal", "itat", {"petitioner": "appellant", "decision_date": "order_date", "case_number": "appeal_no", "judges": "members", "pdf_url": "pdf"}, judgment=("not_empty", "pdf", ""))
_SAT = tribunals.Tribunal("sat", "Securities Appellate Tribunal", "sat", judgment=("equals", "appeal_type", "APPEAL"))
_NCLT = tribunals.Tribunal("nclt", "Company Law Tribunal", "nclt", judgment=("contains", "_path", "orders"))


@query("""
WITH t AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS seg, 1990 + c_nationkey AS y FROM customer WHERE c_custkey % 4 < 3)
SELECT 'ITAT_ITA' || k AS case_id, 'ITA ' || k AS case_number, 'Income Tax Appellate Tribunal' AS court, y || '-03-05 00:00:00' AS decision_date, y AS year, name AS petitioner, 'ITO' AS respondent, 'New Delhi' AS petitioner_city, [seg || ' Rao', 'B Sen'] AS judges,
  name || ' Vs ITO [ITA ' || k || '] (' || y || ')' AS title, 'http://x/' || k AS pdf_url, 'http://x/' || k AS source_pdf_url, '{"respondent":"ITO","odd":' || k || '}' AS raw_metadata, TRUE AS is_judgment FROM t WHERE k % 4 = 0
UNION ALL SELECT 'SAT_' || md5('{"bench": "sat", "date": null, "petitioner": "' || name || '"}')[1:12], NULL, 'Securities Appellate Tribunal', NULL, y, name, '', NULL, [], name || ' (' || y || ')', 'local://sat/pdfs/appeal/' || k || '.pdf', 'local://sat/pdfs/appeal/' || k || '.pdf',
  '{"petitioner":"' || name || '","pdf_filename":"' || k || '.pdf","appeal_type":"Appeal","year":' || y || '}', TRUE FROM t WHERE k % 4 = 1
UNION ALL SELECT 'NCLT_CP' || k, 'CP/' || k, 'Company Law Tribunal', '2020-01-02 00:00:00', 2020, name, '', NULL, [], name || ' [CP/' || k || '] (2020)', 'local://nclt/pdfs/delhi/CP_' || k || '.pdf', 'http://n/' || k,
  '{"pdf_url":["http://n/' || k || '"],"sr_case_title1":"' || name || '","sr_disposal_date":"2020-01-02","sr_n":' || k || '}', FALSE FROM t WHERE k % 4 = 2""")
def tribunal_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw records of three tribunals, one in four without a file; on one schema with their own fields kept."""
    k, name, year = F.col("c_custkey"), F.col("c_name"), 1990 + F.col("c_nationkey")

    def records(rest: int, source: str, fields: dict[str, Column]) -> DataFrame:
        rows = table(spark, sf_dir, "customer").filter(k % 4 == rest)
        return tribunals.parsed(rows.select(F.to_json(F.struct(*(v.alias(f) for f, v in fields.items()))).alias("line"), F.lit(source).alias("source_file")))[0]

    itat = records(0, "itat.jsonl", {"appellant": F.concat(name, F.lit(",NEW DELHI")), "respondent": F.lit("ITO"), "order_date": F.concat(F.lit("05/03/"), year), "appeal_no": F.concat(F.lit("ITA "), k), "members": F.concat("c_mktsegment", F.lit(" Rao, B Sen")), "pdf": F.concat(F.lit("http://x/"), k), "odd": k})
    sat = records(1, "sat.jsonl", {"petitioner": name, "pdf_filename": F.concat(k, F.lit(".pdf")), "appeal_type": F.lit("Appeal"), "year": year})
    nclt = records(2, "raw/delhi-cases.jsonl", {"case_no": F.concat(F.lit("CP/"), k), "pdf_url": F.array(F.concat(F.lit("http://n/"), k)), "search_result": F.struct(name.alias("case_title1"), F.lit("2020-01-02").alias("disposal_date"), k.alias("n"))})
    without = records(3, "sat.jsonl", {"petitioner": name})
    whole = tribunals.union([tribunals.normalized(itat, _ITAT), tribunals.normalized(sat.unionByName(without), _SAT), tribunals.normalized(nclt, _NCLT)])
    return whole.select("case_id", "case_number", "court", "decision_date", "year", "petitioner", "respondent", "petitioner_city", "judges", "title", "pdf_url", "source_pdf_url", F.to_json("raw_metadata").alias("raw_metadata"), "is_judgment")


@query("""
WITH t AS (SELECT c_custkey AS k, c_name, c_mktsegment AS seg, c_custkey % 4 AS m, 1990 + c_nationkey AS y FROM customer)
SELECT k, CASE WHEN m < 2 THEN c_name || ' Vs ' || seg WHEN m = 2 THEN 'Heading ' || k END AS title, CASE WHEN m IN (1, 2) THEN 'Petitioner ' || k WHEN m = 0 THEN c_name END AS petitioner, CASE WHEN m < 2 THEN seg END AS respondent,
  CASE WHEN m IN (1, 2) THEN [seg, 'B'] WHEN m = 0 THEN ['A'] ELSE NULL END AS judges, CASE WHEN m < 2 THEN y || '-01-01' END AS decision_date,
  CASE WHEN m < 2 THEN 'registry' WHEN m = 2 THEN 'text' END AS title_from, CASE WHEN m IN (1, 2) THEN 'text' WHEN m = 0 THEN 'title' END AS petitioner_from FROM t""")
def merged_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cases: half are in a registry, half have texts, a quarter both."""
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    cases = table(spark, sf_dir, "customer").withColumn("k", k)
    registry = cases.filter(k % 4 < 2).select("k", F.concat("c_name", F.lit(" Vs "), seg).alias("title"), F.array(F.lit("A")).alias("judges"), F.concat(1990 + F.col("c_nationkey"), F.lit("-01-01")).alias("decision_date"))
    text = cases.filter((k % 4).isin(1, 2)).select("k", F.concat(F.lit("Heading "), k).alias("heading"), F.concat(F.lit("Petitioner "), k).alias("petitioner"), F.array(seg, F.lit("B")).alias("judges"))
    title = registry.select("k", metadata.from_title(F.col("title")).alias("s")).select("k", "s.*")
    found = metadata.merged(cases.select("k"), {"registry": registry, "text": text, "title": title}, metadata.CASE_RULES, "k")
    return found.select("k", "title", "petitioner", "respondent", "judges", "decision_date", F.element_at("won", F.lit("title")).alias("title_from"), F.element_at("won", F.lit("petitioner")).alias("petitioner_from"))


@query("""
WITH t AS (SELECT o_orderkey AS k, o_custkey % 3 AS m, o_orderdate AS d, o_orderstatus AS s, year(o_orderdate) AS y FROM orders)
SELECT 'C' || k AS corpus_case_id, CASE m WHEN 0 THEN 'Kerala High Court' WHEN 1 THEN 'Supreme Court of India' END AS court_normalized, CASE m WHEN 0 THEN 'high_court' WHEN 1 THEN 'supreme_court' END AS court_type,
  CASE WHEN m = 1 THEN 'AIR ' || y || ' SC ' || k ELSE 'HC-C' || k END AS primary_citation, strftime(d, '%Y-%m-%d') AS decision_date, CASE s WHEN 'F' THEN 'DISPOSED OF' WHEN 'O' THEN 'ALLOWED' END AS disposition_normalized,
  CASE WHEN m < 2 THEN m + 1 END AS bench_strength, CASE WHEN m = 2 THEN 'T' || k ELSE 'T' || k || ' | P' || k END AS snippet FROM t""")
def case_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as first chunks of cases of three kinds of courts."""
    m, key = F.col("o_custkey") % 3, F.col("o_orderkey")
    payloads = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), key).alias("case_id"), F.concat(F.lit("T"), key).alias("title"), F.when(m == 0, "High Court of Kerala").when(m == 1, "Supreme Court of India").alias("court"), F.lit("").alias("court_type"),
        F.when(m == 1, F.concat(F.lit("AIR "), F.year("o_orderdate"), F.lit(" SC "), key)).otherwise("").alias("citation"), F.lit(0).alias("bench_strength"), F.when(m == 0, F.array(F.lit("A"))).when(m == 1, F.array(F.lit("A"), F.lit("B"))).alias("judges"),
        F.when(m == 0, F.date_format("o_orderdate", "dd-MM-yyyy HH:mm:ss")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("decision_date"), F.when(F.col("o_orderstatus") == "F", "Disposed Off").when(F.col("o_orderstatus") == "O", "allowed").otherwise("x").alias("disposition"),
        F.when(m < 2, F.concat(F.lit("P"), key)).alias("petitioner"), F.lit(None).cast("string").alias("respondent"), F.year("o_orderdate").alias("year"),
    )
    return metadata.case_rows(payloads).select("corpus_case_id", "court_normalized", "court_type", "primary_citation", "decision_date", "disposition_normalized", F.col("bench_strength").cast("long").alias("bench_strength"), "snippet")


_REPORTED = "CASE o_orderkey % 4 WHEN 0 THEN '(' || year(o_orderdate) || ') ' || (o_custkey % 20 + 1) || ' SCC ' || o_orderkey WHEN 1 THEN 'AIR ' || (year(o_orderdate) + 1) || ' SC ' || o_orderkey END"


@query(f"""
WITH t AS (SELECT o_orderkey AS case_id, {_REPORTED} AS alias FROM orders)
SELECT case_id, alias, replace(replace(alias, '(', ''), ')', '') AS normalized, CASE WHEN contains(alias, 'SCC') THEN 'SCC' ELSE 'AIR' END AS citation_type FROM t WHERE alias IS NOT NULL""")
def mined_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chunks an order; half of them say where the case is reported, some with a report that is too far off first."""
    key, year, m = F.col("o_orderkey"), F.year("o_orderdate"), F.col("o_orderkey") % 4
    far = F.concat(F.lit("as reported in ("), year - 5, F.lit(") 1 SCC 1, and "))
    said = F.when(m == 0, F.concat(far, F.lit("reported in ("), year, F.lit(") "), F.col("o_custkey") % 20 + 1, F.lit(" SCC "), key)).when(m == 1, F.concat(F.lit("Reported as AIR "), year + 1, F.lit(" SC "), key)).otherwise(F.concat(far, "o_orderpriority"))
    cases = table(spark, sf_dir, "orders").select(key.alias("case_id"), year.alias("year"), F.array(F.concat(F.lit("Head of "), "o_orderpriority"), said).alias("texts"))
    return graph.mined_aliases(cases.select("case_id", "year", F.posexplode("texts").alias("chunk_index", "text")))


@query("""
WITH cited AS (SELECT DISTINCT o_custkey % 500 AS citing, o_orderkey % 300 AS n FROM orders), nodes AS (SELECT DISTINCT n FROM cited WHERE n < 100)
SELECT 'node ' || citing AS citing, 'AIR 2001 SC ' || n AS key, n >= 100 AS stub FROM cited WHERE n >= 100 OR citing <> n""")
def grown_citation_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as citations in two spellings; a third of what they cite is known, the rest become stubs, and none cites itself."""
    n = F.col("o_orderkey") % 300
    raw = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("A.I.R. 2001 SC "), n)).otherwise(F.concat(F.lit("air  2001 sc "), n))
    cited = table(spark, sf_dir, "orders").select(F.concat(F.lit("node "), F.col("o_custkey") % 500).alias("citing"), raw.alias("raw"))
    known = table(spark, sf_dir, "orders").select(n.alias("n")).filter("n < 100").distinct().select(F.concat(F.lit("node "), "n").alias("id"), F.concat(F.lit("AIR 2001 SC "), "n").alias("key"))
    stubs, edges = graph.grown(cited, known, spark.createDataFrame([], "citing string, cited string"))
    nodes = known.withColumn("stub", F.lit(False)).unionByName(stubs.select("id", "key", F.lit(True).alias("stub")))
    return edges.join(nodes, F.col("cited") == F.col("id")).select("citing", "key", "stub")


@query("""
WITH t AS (SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN 'judgment' WHEN 1 THEN 'facts' WHEN 2 THEN 'conclusion' WHEN 3 THEN 'issues' ELSE 'body' END AS section_type FROM conversations), c AS (SELECT section_type, count(*) AS n FROM t GROUP BY 1)
SELECT section_type, n, round(n * 100 / sum(n) OVER (), 2) AS share, row_number() OVER (ORDER BY n DESC, section_type)::INT AS place FROM c""")
def older_section_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as chunks, with a first line that tells their type and whole texts behind it."""
    turn = F.col("turn") % 5
    line = F.when(turn == 0, "  \nFinal Order").when(turn == 1, "The background").when(turn == 2, "It is held").when(turn == 3, "Question no. 1").otherwise("x")
    chunks = table(spark, sf_dir, "conversations").select(classify.older_section_type(F.concat(line, F.lit("\n"), F.coalesce("text", F.lit("")))).alias("section_type"))
    return audit.distribution(chunks, "section_type")


@query("""
SELECT 'k' || o_orderkey AS cnr, CASE o_custkey % 3 WHEN 0 THEN 'Court ' || o_custkey % 6 WHEN 1 THEN o_orderpriority ELSE 'Unknown' END AS court_name, 'c' || o_custkey % 6 AS court_code, strftime(o_orderdate, '%Y-%m-%d') AS decision_date, year(o_orderdate)::INT AS decision_year,
  CASE WHEN o_custkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_of_registration, o_orderstatus = 'F' AS pdf_exists, length(left(repeat(o_orderpriority, 150), 1000))::INT AS kept, '' AS judge FROM orders""")
def registry_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a registry with long markup."""
    court = F.col("o_custkey") % 3
    none = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("k"), "o_orderkey").alias("cnr"), none.alias("title"), F.concat(F.lit("c"), F.col("o_custkey") % 6).alias("court_code"), F.when(court == 1, F.col("o_orderpriority")).alias("court"), F.col("o_orderdate").alias("decision_date"),
        F.when(F.col("o_custkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")).alias("date_of_registration"), *(none.alias(c) for c in ("judge", "disposal_nature", "description", "pdf_link")),
        (F.col("o_orderstatus") == "F").alias("pdf_exists"), F.repeat("o_orderpriority", 150).alias("raw_html"),
    )
    out = sinks.registry_json(rows, {"c0": "Court 0", "c3": "Court 3"})
    return out.select("cnr", "court_name", "court_code", "decision_date", "decision_year", "date_of_registration", "pdf_exists", F.length("raw_html").alias("kept"), "judge")
