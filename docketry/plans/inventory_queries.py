"""Registered queries of inventories, names, joins with metadata and the release, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import naming
from ..operators import inventory, release
from .queries import pick, query, sql_pick, table


@query("SELECT event_type, min(ts)::DATE::VARCHAR AS earliest, max(ts)::DATE::VARCHAR AS latest FROM events GROUP BY 1")
def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return inventory.date_range(events, ["event_type"], "day")


@query("""
WITH t AS (SELECT l_returnflag, count(DISTINCT l_orderkey) AS acts, count(*) AS provisions FROM lineitem GROUP BY 1),
a AS (SELECT l_returnflag, string_agg(l_linestatus || ':' || n, ', ' ORDER BY l_linestatus) AS l_linestatus FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1),
b AS (SELECT l_returnflag, string_agg(v || ':' || n, ', ' ORDER BY v) AS l_linenumber FROM (SELECT l_returnflag, l_linenumber::VARCHAR AS v, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1)
SELECT * FROM t JOIN a USING (l_returnflag) JOIN b USING (l_returnflag)""")
def state_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.state_detail(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_orderkey", ["l_linestatus", "l_linenumber"])


@query("""
SELECT 'status' AS dimension, v AS value, count(*) AS n FROM (SELECT o_orderstatus AS v FROM orders UNION ALL SELECT l_linestatus FROM lineitem) GROUP BY v
UNION ALL SELECT 'year', v::VARCHAR, count(*) FROM (SELECT year(o_orderdate) AS v FROM orders UNION ALL SELECT year(l_shipdate) FROM lineitem) GROUP BY v
UNION ALL SELECT 'flag', l_returnflag, count(*) FROM lineitem GROUP BY l_returnflag""")
def merged_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("status"), F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("flag"))
    return inventory.merged_distribution([orders, lines], ["status", "year", "flag"])


_ACT_IDS = ["REG_SEBI_", "IND_central_", "IND_state_", "IND_REP_", "IND_SPENT_", "XX_"]
_ACTS = f"SELECT *, {sql_pick('l_orderkey', _ACT_IDS)} || l_orderkey AS act_id FROM lineitem"
_ISSUERS = f"""
acts AS (SELECT act_id, count(*) AS provisions, max(year(l_shipdate)) AS y FROM ({_ACTS}) GROUP BY 1),
of AS (SELECT *, split_part(act_id, '_', 1) AS a, split_part(act_id, '_', 2) AS b FROM acts),
issued AS (SELECT CASE WHEN a = 'REG' THEN b WHEN a = 'IND' AND b = 'central' THEN 'CENTRAL' WHEN a = 'IND' AND b = 'state' THEN 'STATE' WHEN a = 'IND' AND b = 'REP' THEN 'REPEALED' WHEN a = 'IND' AND b = 'SPENT' THEN 'SPENT' ELSE 'OTHER' END AS issuer,
  CASE WHEN a = 'REG' THEN 'regulator instrument' WHEN b = 'central' THEN 'Central Act' WHEN b = 'state' THEN 'State or UT legislation' WHEN b = 'REP' THEN 'repealed Act' WHEN b = 'SPENT' THEN 'spent Act' ELSE 'other' END AS kind, * FROM of)"""


def _acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    act_id = F.concat(pick(F.col("l_orderkey"), _ACT_IDS), F.col("l_orderkey").cast("string"))
    return table(spark, sf_dir, "lineitem").select(act_id.alias("act_id"), F.year("l_shipdate").alias("year"))


@query(f"""
WITH {_ISSUERS}
SELECT issuer, kind, count(*) AS instruments, sum(provisions)::BIGINT AS provisions, min(y)::INT AS earliest_year, max(y)::INT AS latest_year, count(y) AS instruments_with_year FROM issued GROUP BY ALL""")
def issuer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.issuers(_acts(spark, sf_dir), "act_id", "year")


@query("""
SELECT 'instruments' AS measure, count(DISTINCT l_orderkey) AS parts, count(DISTINCT l_orderkey) AS whole, TRUE AS reconciles FROM lineitem
UNION ALL SELECT 'provisions', count(*), count(*), TRUE FROM lineitem""")
def issuers_add_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = _acts(spark, sf_dir)
    whole = acts.agg(F.count_distinct("act_id").alias("instruments"), F.count("*").alias("provisions"))
    return inventory.adds_up(inventory.issuers(acts, "act_id", "year"), ["instruments", "provisions"], whole)


_KEYS = ["pdfs/", "IND_REP_", "judgments/"]
_ENDS = [".PDF", ".json", "", "/act.txt"]
_OBJECTS = f"SELECT {sql_pick('doc_id', _KEYS)} || source || '/' || lang || {sql_pick('doc_id', _ENDS)} AS key, n_chars AS bytes, (DATE '2020-01-01' + (doc_id % 1000)::INT)::VARCHAR AS modified FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL"


@query(f"""
WITH o AS ({_OBJECTS}), p AS (SELECT *, string_split(key, '/') AS s, lower(regexp_extract(key, '\\.([A-Za-z0-9]{{1,6}})$', 1)) AS e FROM o),
f AS (SELECT CASE WHEN starts_with(key, 'IND_') THEN '(per-act folders)' WHEN len(s) > 2 THEN s[1] || '/' || s[2] ELSE s[1] END AS folder, CASE e WHEN '' THEN '(no extension)' ELSE e END AS extension, bytes, modified FROM p)
SELECT CASE WHEN grouping(folder) = 1 THEN '__total__' ELSE folder END AS folder, CASE WHEN grouping(extension) = 1 THEN '__total__' ELSE extension END AS extension,
  count(*) AS objects, sum(bytes)::BIGINT AS bytes, min(modified) AS oldest, max(modified) AS newest FROM f GROUP BY ROLLUP (folder, extension)""")
def objects_by_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("source is not null and lang is not null")
    key = F.concat(pick(F.col("doc_id"), _KEYS), "source", F.lit("/"), "lang", pick(F.col("doc_id"), _ENDS))
    modified = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 1000).cast("int")), "yyyy-MM-dd")
    return inventory.objects_by_folder(docs.select(key.alias("key"), F.col("n_chars").alias("bytes"), modified.alias("modified")))


_SAMPLED = "SELECT source, lang, n_chars, CASE WHEN n_chars > 2000 THEN 'substantive decision' WHEN n_chars > 500 THEN 'short order' ELSE 'other' END AS class FROM documents WHERE source IS NOT NULL"


def _sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("n_chars") > 2000, "substantive decision").when(F.col("n_chars") > 500, "short order").otherwise("other")
    return table(spark, sf_dir, "documents").filter("source is not null").select("source", "n_chars", kind.alias("class"))


@query(f"SELECT source, class, n, round(100 * n / sum(n) OVER (PARTITION BY source), 1) AS pct FROM (SELECT source, class, count(*) AS n FROM ({_SAMPLED}) GROUP BY ALL)")
def class_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.class_shares(_sampled(spark, sf_dir), "source", "class")


@query("""
WITH s AS (SELECT source, list_sort(list(n_chars) FILTER (n_chars > 0)) AS v FROM documents WHERE source IS NOT NULL GROUP BY 1)
SELECT source, coalesce(v[len(v) // 2 + 1], 0) AS median FROM s""")
def median_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.upper_median(_sampled(spark, sf_dir), "source", "n_chars")


@query(f"""
WITH s AS (SELECT source, count(*) AS objects, round(100 * count(*) FILTER (class = 'substantive decision') / count(*), 1) AS pct FROM ({_SAMPLED}) GROUP BY 1)
SELECT source, objects, pct, round(objects * pct / 100)::BIGINT AS estimate FROM s""")
def estimated_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = _sampled(spark, sf_dir)
    totals = sample.groupBy("source").agg(F.count("*").alias("objects"))
    return inventory.estimates(totals, inventory.class_shares(sample, "source", "class"), "source", "class", "substantive decision")


@query("""
WITH c AS (SELECT l_orderkey, count(*) AS chunks, count(*) FILTER (l_discount * 10 >= 0.5) AS corrupted, avg(l_discount * 10) FILTER (l_discount * 10 >= 0.5) AS av, max(l_discount * 10) FILTER (l_discount * 10 >= 0.5) AS hi,
  list(l_linenumber::VARCHAR ORDER BY l_linenumber) FILTER (l_discount * 10 >= 0.5) AS s FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM (SELECT l_orderkey, l_linenumber, max(l_discount) AS l_discount FROM lineitem GROUP BY ALL)) GROUP BY 1)
SELECT l_orderkey, chunks, corrupted, round(corrupted / chunks, 3) AS ratio, round(av, 3) AS average, round(hi, 3) AS highest,
  CASE WHEN corrupted / chunks >= 0.5 AND av >= 0.5 THEN 'DEFINITE' WHEN corrupted / chunks >= 0.3 AND av >= 0.4 THEN 'PARTIAL' ELSE 'BORDERLINE' END AS class,
  array_to_string(s[1:3], ' | ') AS samples, CASE WHEN corrupted / chunks >= 0.5 AND av >= 0.5 THEN 0 WHEN corrupted / chunks >= 0.3 AND av >= 0.4 THEN 1 ELSE 2 END::INT AS place FROM c WHERE corrupted > 0""")
def corruption_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_discount").alias("l_discount"))
    chunks = lines.select("l_orderkey", (F.col("l_discount") * 10).alias("score"), "l_linenumber", F.col("l_linenumber").cast("string").alias("text"))
    return inventory.corruption_report(chunks, "l_orderkey", "score", "l_linenumber", "text", 0.5)


@query("SELECT year(o_orderdate)::INT AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def records_by_year_and_court(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return orders.groupBy("year", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT n_name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey AND c_acctbal > 9000 GROUP BY 1")
def refreshed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, rich = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer").filter("c_acctbal > 9000")
    rows = rich.join(nation, F.col("n_nationkey") == F.col("c_nationkey")).select("n_name")
    return inventory.table_counts(nation.select("n_name"), rows, "n_name")


@query("""
WITH o AS (SELECT conv_id, text, row_number() OVER w AS no, coalesce(sum(length(coalesce(text, '')) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, count(*) AS chunks, md5(string_agg(coalesce(text, '') || chr(10) || chr(10), '' ORDER BY no)) AS text_md5 FROM o WHERE no <= 20 AND before <= 300 GROUP BY 1 HAVING trim(string_agg(coalesce(text, ''), '')) <> ''""")
def capped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = inventory.capped_texts(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", 20, 300)
    return capped.select("conv_id", "chunks", F.md5("text").alias("text_md5"))


@query("SELECT conv_id, role, md5(text) AS text_md5 FROM conversations WHERE turn = 0")
def first_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.matching(table(spark, sf_dir, "conversations"), {"turn": 0}).select("conv_id", "role", F.md5("text").alias("text_md5"))


@query("""
SELECT c_custkey, c_mktsegment, e.event_type, e.event_id FROM customer LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1) e ON c_custkey = user_id""")
def documents_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their last event: of repeated metadata the last row counts."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), "event_type", "event_id")
    return inventory.with_metadata(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), events, "c_custkey", ["event_id"])


@query("SELECT o_orderkey, o_custkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def cases_with_all_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two left joins by key; Spark broadcasts a side whose size it knows to be small."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    out = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.select("o_orderkey", "o_custkey", "c_name", "n_name")


@query("SELECT d.doc_id, d.source, url IS NOT NULL AS has_html, length(html) AS html_chars FROM documents d LEFT JOIN pages ON doc_id = page_id")
def acts_with_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = table(spark, sf_dir, "documents").select("doc_id", "source")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").isNotNull().alias("has_html"), F.length("html").cast("long").alias("html_chars"))
    return acts.join(pages, "doc_id", "left").withColumn("has_html", F.coalesce("has_html", F.lit(False)))


@query("SELECT event_id, c_custkey, c_name FROM events JOIN customer ON user_id = c_custkey")
def aliases_of_known_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey")).select("event_id", "c_custkey", "c_name")


@query("""
WITH notes AS (SELECT l_orderkey AS doc, l_suppkey % 7 + 1 AS marker, arg_max(l_partkey, (l_linenumber, l_partkey)) AS body FROM lineitem GROUP BY ALL)
SELECT l_orderkey AS doc, l_linenumber::BIGINT AS marker, body FROM lineitem LEFT JOIN notes ON l_orderkey = doc AND l_linenumber = marker""")
def resolved_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    markers = lines.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("long").alias("marker"))
    notes = lines.select(F.col("l_orderkey").alias("doc"), (F.col("l_suppkey") % 7 + 1).alias("marker"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("body"))
    return inventory.resolved_markers(markers, notes, "doc", "marker", ["line", "body"]).select("doc", "marker", "body")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def cases_without_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = inventory.matching(table(spark, sf_dir, "lineitem"), {"l_returnflag": "R"}).select(F.col("l_orderkey").alias("o_orderkey"))
    return inventory.matching(table(spark, sf_dir, "orders"), {"o_orderstatus": "F"}).join(aliases, "o_orderkey", "left_anti").select("o_orderkey", "o_totalprice")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def not_yet_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT r_name, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def totals_by_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    placed = table(spark, sf_dir, "supplier").join(folders, F.col("s_nationkey") == F.col("n_nationkey"))
    return placed.groupBy("r_name").agg(F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance"))


@query("""
WITH q AS (SELECT n_nationkey, y AS year, p AS priority FROM nation, (SELECT unnest(range(1992, 1999)) AS y), (SELECT unnest(['1-URGENT', '2-HIGH', '5-LOW']) AS p)),
done AS (SELECT c_nationkey, year(o_orderdate) AS y, o_orderpriority AS p FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000)
SELECT n_nationkey, year::INT AS year, priority FROM q WHERE NOT EXISTS (SELECT 1 FROM done WHERE c_nationkey = n_nationkey AND done.y = q.year AND done.p = q.priority)""")
def work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    done = large.select(F.col("c_nationkey").alias("n_nationkey"), F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("priority"))
    axes = {"year": list(range(1992, 1999)), "priority": ["1-URGENT", "2-HIGH", "5-LOW"]}
    return inventory.work_queue(table(spark, sf_dir, "nation").select("n_nationkey"), axes, done, ["n_nationkey", "year", "priority"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F' AND l_quantity >= 10 AND l_quantity < 20")
def filtered_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.matching(table(spark, sf_dir, "lineitem"), {"l_returnflag": ["A", "R"], "l_linestatus": "F", "l_quantity": (10.0, 20.0)}).select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate <= TIMESTAMP '1997-12-31' ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def latest_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inventory.latest(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey", F.lit("1997-12-31").cast("timestamp"), 100)
    return found.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS lo, strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m-%d') AS hi, count(*) AS n FROM orders GROUP BY ALL")
def month_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    sliced = table(spark, sf_dir, "orders").select(naming.month_slice(F.col("o_orderdate")).alias("m"))
    return sliced.groupBy(F.date_format("m.lo", "yyyy-MM-dd").alias("lo"), F.date_format("m.hi", "yyyy-MM-dd").alias("hi")).agg(F.count("*").alias("n"))


_LABELS = [*naming.COURT_NAMES, "High Court", "Supreme Court", None]


@query(f"""
SELECT c_custkey, {sql_pick("c_custkey", [*naming.COURT_NAMES.values(), naming.UNRESOLVED_COURT, "Supreme Court", None])} AS court FROM customer""")
def court_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", naming.court_label(pick(F.col("c_custkey"), _LABELS)).alias("court"))


@query(f"""
WITH t AS (SELECT c_custkey, c_nationkey::VARCHAR AS s, MAP {{'1': 'Jammu & Kashmir', '2': 'Tripura', '3': 'Himachal Pradesh', '4': 'Uttarakhand', '5': 'Andhra Pradesh', '7': 'Delhi', '8': 'Rajasthan', '9': 'Uttar Pradesh', '10': 'Bihar', '11': 'Sikkim', '14': 'Manipur', '16': 'Telangana', '17': 'Meghalaya', '18': 'Assam', '19': 'West Bengal', '20': 'Jharkhand', '21': 'Odisha', '22': 'Chhattisgarh', '23': 'Madhya Pradesh', '24': 'Gujarat', '25': 'Rajasthan', '26': 'Punjab & Haryana', '27': 'Maharashtra', '28': 'Delhi', '29': 'Uttar Pradesh', '30': 'Karnataka', '31': 'Kerala', '32': 'Tamil Nadu', '33': 'Tamil Nadu', '36': 'Andhra Pradesh'}} AS m FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE s END AS state_code, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_custkey || '_x' END AS establishment_code,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE coalesce(m[s], 'State ' || s) END AS state_name FROM t""")
def court_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, key = F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")
    code = F.when(F.col("c_custkey") % 5 == 0, nation).otherwise(F.concat(nation, F.lit("_"), key, F.lit("_x")))
    return table(spark, sf_dir, "customer").select("c_custkey", naming.court_code(code).alias("c")).select("c_custkey", "c.*")


@query("""
WITH t AS (SELECT p_partkey, p_partkey % 4 AS k, replace(p_name, ' ', '_') AS slug, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS words FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN words WHEN 1 THEN words WHEN 2 THEN 'Bench (' || replace(slug, '_', '') || ')' ELSE 'Wing of ' || p_partkey % 8 END AS bench FROM t""")
def bench_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs of parts' names with a court before them, without one, and in one word; and some that are listed."""
    key, name = F.col("p_partkey"), F.col("p_name")
    slug = F.when(key % 4 == 0, F.concat(F.lit("calcutta_"), F.replace(name, F.lit(" "), F.lit("_")))).when(key % 4 == 1, F.upper(F.replace(name, F.lit(" "), F.lit("_")))).when(key % 4 == 2, F.replace(name, F.lit(" "), F.lit(""))).otherwise(F.concat(F.lit("wing"), key % 8))
    return table(spark, sf_dir, "part").select("p_partkey", naming.bench_name(slug, {f"wing{k}": f"Wing of {k}" for k in range(8)}).alias("bench"))


@query("""
SELECT p_partkey, p_partkey % 3 = 0 AS supreme, CASE p_size % 4 WHEN 0 THEN 'repealed' WHEN 1 THEN 'spent' ELSE 'in_force' END AS status FROM part""")
def ids_and_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    case_id = F.concat(pick(F.col("p_partkey"), ["2019_", "HC2019_", "201_"]), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", naming.is_supreme_id(case_id).alias("supreme"), naming.act_status(pick(F.col("p_size"), ["Repealed", "SPENT", "central", None])).alias("status"))


_TITLES = ["Short title of ", "Extent, ", "Definitions of ", "Interpretation: ", "Amendment of the Act on ", "First Schedule, ", "Preamble to ", "Penalty for "]


@query(f"""
WITH t AS (SELECT p_partkey, (p_partkey % 2)::VARCHAR AS number, lower({sql_pick("p_partkey", _TITLES)} || p_name) AS title FROM part)
SELECT p_partkey, CASE WHEN number = '1' AND (contains(title, 'short title') OR contains(title, 'extent')) THEN 'short_title' WHEN contains(title, 'definition') OR contains(title, 'interpretation') THEN 'definitions'
    WHEN contains(title, 'amendment') AND contains(title, 'act') THEN 'amendment_provision' ELSE 'section' END AS section_class,
  CASE WHEN number = '1' AND (contains(title, 'short title') OR contains(title, 'extent')) THEN 'short_title' WHEN contains(title, 'definition') OR contains(title, 'interpretation') THEN 'definitions'
    WHEN contains(title, 'schedule') THEN 'schedule' WHEN contains(title, 'preamble') THEN 'preamble' ELSE 'section' END AS html_class FROM t""")
def section_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of sections with parts' names in them; SQL reads the same titles."""
    number, title = (F.col("p_partkey") % 2).cast("string"), F.concat(pick(F.col("p_partkey"), _TITLES), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", naming.section_class(number, title).alias("section_class"), naming.section_class(number, title, html=True).alias("html_class"))


_TENS, _ONES = ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"], ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]


@query(f"""
WITH t AS (SELECT p_partkey, p_partkey % 150 + 1 AS n FROM part), r AS (SELECT *, CASE WHEN n >= 100 THEN 'C' ELSE '' END || {sql_pick("n % 100 // 10", _TENS)} || {sql_pick("n", _ONES)} AS numeral FROM t)
SELECT p_partkey, n <= 100 AND length(numeral) <= 6 AS roman, n <= 100 AND length(numeral) <= 6 AND p_partkey % 7 <> 0 AS marked FROM r""")
def roman_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numerals of 1 to 150, of which those to 100 count unless they are long; one in seven with a letter too many."""
    n = F.col("p_partkey") % 150 + 1
    numeral = F.concat(F.when(n >= 100, "C").otherwise(""), pick(F.floor(n % 100 / 10), _TENS), pick(n, _ONES))
    marked = F.concat(numeral, F.when(F.col("p_partkey") % 7 == 0, "H").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", naming.is_roman(numeral).alias("roman"), naming.is_roman(marked).alias("marked"))


_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, (SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}')::INT AS columns, count(*) AS rows FROM {t}" for t in _TABLES))
def parquet_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.parquet_sizes({t: table(spark, sf_dir, t) for t in _TABLES})


# the release: chunks of a case are turns of a conversation
_BARRED = ["", " Cite this article", "", " It shall not be published.", ""]
_ORIGINAL = """CASE WHEN turn % 2 = 0 THEN 'Original of turn ' || turn || CASE WHEN conv_id % 4 = 0 THEN ' call 9876543210' ELSE '' END || CASE WHEN conv_id % 7 = 3 AND turn = 2 THEN ' heard in camera' ELSE '' END WHEN turn % 5 = 3 THEN '' END"""
_CASES = f"""
chunks AS (SELECT conv_id, turn, 'Turn ' || turn || ' by ' || coalesce(role, '?') || CASE WHEN conv_id % 3 = 0 THEN ' call 9447091300 or write to a.b@example.org' ELSE '' END ||
  CASE WHEN turn = 1 THEN {sql_pick("conv_id", _BARRED)} ELSE '' END AS text, {_ORIGINAL} AS text_original, role FROM conversations),
judged AS (SELECT *, coalesce(nullif(text_original, ''), text) AS t FROM chunks),
cases AS (SELECT conv_id, count(*) AS parts, CASE WHEN bool_or(contains(t, 'Cite this')) THEN 'purged_third_party_source' WHEN bool_or(contains(t, 'shall not be published') OR contains(t, 'in camera')) THEN 'excluded_non_publication' ELSE 'kept' END AS status FROM judged GROUP BY 1),
kept AS (SELECT c.* FROM chunks c JOIN cases s ON c.conv_id = s.conv_id AND s.status = 'kept')"""
_JUDGES = ['["A. Rao", "B. Sen"]', "C. Das", "", None]


def _case_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    text = F.concat(
        F.lit("Turn "), turn.cast("string"), F.lit(" by "), F.coalesce("role", F.lit("?")), F.when(conv % 3 == 0, " call 9447091300 or write to a.b@example.org").otherwise(""), F.when(turn == 1, pick(conv, _BARRED)).otherwise("")
    )
    original = F.concat(F.lit("Original of turn "), turn.cast("string"), F.when(conv % 4 == 0, " call 9876543210").otherwise(""), F.when((conv % 7 == 3) & (turn == 2), " heard in camera").otherwise(""))
    fields = {
        "case_id": conv, "chunk_index": turn, "text": text, "text_original": F.when(turn % 2 == 0, original).when(turn % 5 == 3, ""),
        "chunk_id": F.concat_ws("_", conv, turn), "total_chunks": F.when(turn % 3 == 0, "three").otherwise(F.concat(F.lit(" "), turn.cast("string"))), "char_start": turn * 10, "page_start": turn.cast("string"),
        "box_aware": F.when(turn % 2 == 0, "yes").otherwise(""), "judges": pick(conv, _JUDGES), "court": F.col("role"), "year": F.concat(F.lit("20"), F.lpad((conv % 100).cast("string"), 2, "0")), "not_published": F.lit("x"),
    }
    return table(spark, sf_dir, "conversations").select(*(c.alias(name) for name, c in fields.items()))


@query(f"WITH {_CASES} SELECT conv_id AS case_id, parts, status FROM cases")
def case_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.case_status(_case_chunks(spark, sf_dir))


def _masked(column: str) -> str:
    return f"replace(replace(replace({column}, '9447091300', '[REDACTED]'), 'a.b@example.org', '[REDACTED]'), '9876543210', '[REDACTED]')"


@query(f"""
WITH {_CASES}
SELECT conv_id::VARCHAR AS case_id, conv_id || '_' || turn AS chunk_id, turn AS chunk_index, CASE WHEN turn % 3 <> 0 THEN turn END AS total_chunks, {_masked("text")} AS text, {_masked("text_original")} AS text_original,
  turn * 10 AS char_start, NULL::BIGINT AS char_end, turn AS page_start, NULL::BIGINT AS page_end, NULL::VARCHAR AS section_type, NULL::BIGINT AS section_priority, turn % 2 = 0 AS box_aware,
  role AS court, NULL::VARCHAR AS court_code, NULL::VARCHAR AS court_type, NULL::VARCHAR AS bench, NULL::BIGINT AS bench_strength,
  CASE conv_id % 4 WHEN 0 THEN ['A. Rao', 'B. Sen'] WHEN 1 THEN ['C. Das'] ELSE []::VARCHAR[] END AS judges, NULL::VARCHAR AS title, NULL::VARCHAR AS description, NULL::VARCHAR AS petitioner, NULL::VARCHAR AS respondent,
  NULL::VARCHAR AS disposition, '' AS case_number, '' AS citation, NULL::VARCHAR AS decision_date, NULL::VARCHAR AS date_of_registration, 2000 + conv_id % 100 AS year, '' AS source_url, 'en' AS language_code FROM kept""")
def released_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole cases dropped by any of their chunks; the rest with both texts redacted, on the whole published schema."""
    chunks = _case_chunks(spark, sf_dir)
    return release.published(release.redacted_chunks(chunks, release.case_status(chunks)))


@query(f"""
WITH {_CASES}, hits AS (SELECT unnest(['phone', 'email', 'phone']) AS rule, unnest([contains(text, '9447091300'), contains(text, 'a.b@example.org'), coalesce(contains(text_original, '9876543210'), FALSE)]) AS hit FROM kept)
SELECT 'documents_' || status AS name, count(*) AS n FROM cases GROUP BY 1
UNION ALL SELECT 'chunks_kept', count(*) FROM kept
UNION ALL SELECT 'redacted_' || rule, count(*) FROM hits WHERE hit GROUP BY 1""")
def release_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _case_chunks(spark, sf_dir)
    status = release.case_status(chunks)
    return release.release_counts(status, release.redacted_chunks(chunks, status))
