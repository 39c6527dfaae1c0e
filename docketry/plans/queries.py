"""Registered queries over the driver's tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import classify, extract, judgments, redaction, text
from ..operators import audit, chunking, joins, retrieval
from ..streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows in some parts a core, by ``keys`` if given: what one small file holds can be much work, and would be one task's."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# what SQL expects, written down apart from the operators' own lists
_ENGLISH = "the of and to in a is that for it was on are as with his they be at one have this from or had by not but what all were when we there can an your which their said if do will each about how up out them shall court case order section act petition respondent appellant petitioner applicant state"
_STOPWORDS = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with"


def _english(column: str) -> str:
    words = ", ".join(f"'{w}'" for w in _ENGLISH.split())
    return f"len(list_filter({column}, lambda w: list_contains([{words}], regexp_replace(w, '^[.,;:()\"'']+|[.,;:()\"'']+$', '', 'g'))))"


@query(f"""
WITH s AS (SELECT source, lang, text, left(text, 5000) AS sample FROM documents),
w AS (SELECT *, list_filter(string_split_regex(lower(sample), '\\s+'), lambda x: x <> '')[1:200] AS words FROM s),
r AS (SELECT *, {_english("words")} / nullif(len(words), 0) AS english,
        length(regexp_replace(sample, '[^\\x{{0900}}-\\x{{097F}}]', '', 'g')) / length(sample) AS hindi,
        length(regexp_replace(sample, '[^ -~]', '', 'g')) / length(sample) AS ascii,
        length(regexp_replace(sample, '[^\\x{{00C0}}-\\x{{024F}}]', '', 'g')) / length(sample) AS latin FROM w)
SELECT source, lang, CASE WHEN length(trim(coalesce(text, ''))) < 100 THEN 'empty' WHEN hindi > 0.15 AND ascii > 0.3 THEN 'mixed' WHEN hindi > 0.15 THEN 'hindi_unicode'
  WHEN english > 0.08 THEN 'english' WHEN latin > 0.03 THEN 'gibberish' WHEN english < 0.03 THEN 'gibberish' ELSE 'english' END AS class, count(*) AS n
FROM r GROUP BY ALL""")
def language_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "lang", classify.language_class(F.col("text")).alias("class"))
    return audit.facet(docs, "source", "lang", "class")


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL")
def facet_source_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.facet(table(spark, sf_dir, "documents"), "source", "lang")


@query("""
WITH c AS (SELECT count(*) AS total, count(*) FILTER (text IS NULL OR text = '') AS text, count(*) FILTER (lang IS NULL OR lang = '') AS lang,
  count(*) FILTER (source IS NULL OR source = '') AS source, count(*) FILTER (n_chars IS NULL) AS n_chars FROM documents)
SELECT x.field AS field, x.missing AS missing, total, round(x.missing * 100 / total, 2) AS pct FROM (SELECT total, unnest([
  {field: 'text', missing: text}, {field: 'lang', missing: lang}, {field: 'source', missing: source}, {field: 'n_chars', missing: n_chars}]) AS x FROM c)""")
def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.missing_fields(table(spark, sf_dir, "documents"), ["text", "lang", "source", "n_chars"])


@query("""
WITH p AS (SELECT l_returnflag, l_linestatus, l_orderkey, count(*) AS parts FROM lineitem GROUP BY ALL),
s AS (SELECT l_returnflag, l_linestatus, list_sort(list(parts)) AS v, count(*) AS cases, sum(parts)::BIGINT AS rows FROM p GROUP BY ALL)
SELECT l_returnflag, l_linestatus, cases, rows, v[1] AS min, v[cases // 2 + 1] AS p50, v[least(cases - 1, cases * 95 // 100) + 1] AS p95, v[cases] AS max, rows / cases AS mean FROM s""")
def parts_per_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.parts_per_case(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_orderkey")


@query("""
WITH per AS (SELECT DISTINCT event_type, date_trunc('day', ts) AS day, user_id FROM events),
s AS (SELECT event_type, count(*) AS sum_of_periods, count(DISTINCT user_id) AS cases FROM per GROUP BY 1)
SELECT event_type, sum_of_periods, cases, sum_of_periods - cases AS overlap FROM s""")
def overlap_of_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", F.date_trunc("day", "ts").alias("day"), "user_id")
    return audit.overlap_of_periods(events, "event_type", "day", "user_id")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _order_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")


@query(f"""
SELECT year(o_orderdate)::INT AS year, {", ".join(f'''nullif(count(*) FILTER (o_orderpriority = '{p}'), 0) AS "{p}"''' for p in PRIORITIES)},
  ({" + ".join(f"count(*) FILTER (o_orderpriority = '{p}')" for p in PRIORITIES)})::BIGINT AS total FROM orders GROUP BY 1""")
def year_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.year_matrix(_order_years(spark, sf_dir), "year", "o_orderpriority", PRIORITIES, F.count(F.lit(1)))


@query("""
SELECT CASE WHEN grouping(year) = 1 THEN '__total__' ELSE year::VARCHAR END AS year, CASE WHEN grouping(o_orderstatus) = 1 THEN '__total__' ELSE o_orderstatus END AS o_orderstatus,
  count(DISTINCT o_custkey) AS entities, count(*) AS rows
FROM (SELECT year(o_orderdate) AS year, * FROM orders) GROUP BY ROLLUP (year, o_orderstatus)""")
def year_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.rollup_distinct(_order_years(spark, sf_dir), "year", "o_orderstatus", "o_custkey")


@query("""
SELECT 'l_returnflag' AS dimension, l_returnflag AS value, count(DISTINCT l_orderkey) AS entities, count(*) AS rows FROM lineitem GROUP BY 2
UNION ALL SELECT 'l_linestatus', l_linestatus, count(DISTINCT l_orderkey), count(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'l_linenumber', l_linenumber::VARCHAR, count(DISTINCT l_orderkey), count(*) FROM lineitem GROUP BY 2""")
def dimension_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.by_dimensions(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"], "l_orderkey")


_YEAR_COUNTS = "c AS (SELECT o_orderpriority, year(o_orderdate)::INT AS year, count(*) AS n FROM orders GROUP BY ALL)"


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.facet(_order_years(spark, sf_dir), "o_orderpriority", "year")


@query(f"""
WITH {_YEAR_COUNTS}, s AS (SELECT *, sum(n) OVER (PARTITION BY o_orderpriority ORDER BY year) * 100 AS r, sum(n) OVER (PARTITION BY o_orderpriority) AS w FROM c)
SELECT o_orderpriority, min(year) FILTER (r >= 5 * w) AS core_from, min(year) FILTER (r >= 95 * w) AS core_to, max(w)::BIGINT AS total FROM s GROUP BY 1""")
def core_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.core_period(_counts(spark, sf_dir), "o_orderpriority", "year", "n")


@query(f"""
WITH {_YEAR_COUNTS}, p AS (SELECT *, max(n) OVER (PARTITION BY o_orderpriority) AS peak FROM c)
SELECT o_orderpriority, max(year) AS cutoff, max(peak) AS peak FROM p WHERE n * 100 >= 25 * peak GROUP BY 1""")
def cutoff_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.cutoff_year(_counts(spark, sf_dir), "o_orderpriority", "year", "n")


@query(f"WITH {_YEAR_COUNTS} SELECT o_orderpriority, min(year) FILTER (n >= 400) AS first_dense, count(*) FILTER (n >= 400) AS dense_years FROM c GROUP BY 1")
def dense_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.dense_years(_counts(spark, sf_dir), "o_orderpriority", "year", "n", 400)


@query("""
WITH c AS (SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT n_name, n, rank() OVER (ORDER BY n DESC)::INT AS place, round(n * 100 / sum(n) OVER (), 2) AS share, (rank() OVER (ORDER BY n DESC) - 1)::INT AS larger FROM c""")
def ranked_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    counts = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))
    return audit.ranked(counts, "n", "n_name")


@query("""
SELECT CASE WHEN v IS NULL THEN 'null' WHEN v < 10 THEN 'below' WHEN v > 30 THEN 'above' ELSE v::VARCHAR END AS bucket, count(*) AS n, TRUE AS whole
FROM (SELECT p_size AS v FROM part) GROUP BY 1""")
def reconciled_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.reconciled_buckets(table(spark, sf_dir, "part"), F.col("p_size"), 10, 30)


@query("""
WITH r AS (SELECT lang AS name, source AS collection, count(*) AS cases, count(*) - count(DISTINCT text) AS duplicates, min(doc_id) AS earliest, max(doc_id) AS latest FROM documents GROUP BY ALL)
SELECT name, (sum(cases) - sum(duplicates))::BIGINT AS cases, min(earliest) AS earliest, max(latest) AS latest, list_sort(list(DISTINCT collection)) AS collections FROM r GROUP BY 1""")
def merged_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("name"), F.col("source").alias("collection")).agg(
        F.count("*").alias("cases"), (F.count("*") - F.count_distinct("text")).alias("duplicates"), F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest")
    )
    return audit.merged_collections(per, "name")


@query("""
SELECT 'customer' AS tag, c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL
SELECT 'supplier', s_name, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT 'nation', n_name, n_nationkey, NULL FROM nation""")
def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("nation"))
    return audit.tagged_union({"customer": customer, "supplier": supplier, "nation": nation}, ["name", "nation", "balance"])


_HALVES = "a AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'O')"


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")), orders.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("k"))


@query(f"""
WITH {_HALVES} SELECT (SELECT count(DISTINCT k) FROM a) AS left_keys, (SELECT count(DISTINCT k) FROM b) AS right_keys,
 (SELECT count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b)) AS shared, (SELECT count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)) AS deduplicated""")
def set_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.set_overlap(*_halves(spark, sf_dir), "k")


@query(f"WITH {_HALVES} SELECT k, count(*) AS n FROM a WHERE k IN (SELECT k FROM b) GROUP BY 1")
def present_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _halves(spark, sf_dir)
    return audit.facet(joins.present_in(left, right, "k"), "k")


@query(f"""
WITH {_HALVES} SELECT c_custkey AS k, CASE WHEN c_custkey NOT IN (SELECT k FROM a) THEN 'no_index_entry' WHEN c_custkey NOT IN (SELECT k FROM b) THEN 'NOT_in_bucket' ELSE 'mirrored' END AS status FROM customer""")
def mirror_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return joins.mirror_status(local, *_halves(spark, sf_dir), "k")


@query("""
WITH a AS (SELECT o_custkey % 100 AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey % 100 AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
j AS (SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS left_n, coalesce(b.n, 0) AS right_n FROM a FULL JOIN b ON a.k = b.k)
SELECT *, right_n - left_n AS delta, round((right_n - left_n) * 100 / nullif(left_n, 0), 3) AS delta_pct, CASE WHEN right_n > left_n THEN 'more' WHEN right_n < left_n THEN 'fewer' ELSE 'same' END AS direction FROM j""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = (audit.facet(x.select((F.col("k") % 100).alias("k")), "k") for x in _halves(spark, sf_dir))
    return joins.reconcile(left, right, "k", "n")


@query("""
WITH c AS (SELECT source, lang, count(*) AS cases FROM documents GROUP BY ALL), d AS (SELECT source, lang, count(*) - 1 AS duplicates FROM documents GROUP BY source, lang, text HAVING count(*) > 1),
s AS (SELECT source, lang, sum(duplicates) AS duplicates FROM d GROUP BY ALL)
SELECT c.source, c.lang, (cases - coalesce(duplicates, 0))::BIGINT AS net FROM c LEFT JOIN s ON c.source = s.source AND c.lang = s.lang WHERE cases > coalesce(duplicates, 0)""")
def net_of_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    copies = docs.groupBy("source", "lang", "text").agg((F.count("*") - 1).alias("duplicates")).filter("duplicates > 0").groupBy("source", "lang").agg(F.sum("duplicates").alias("duplicates"))
    return joins.net_of_duplicates(docs.groupBy("source", "lang").agg(F.count("*").alias("cases")), copies, ["source", "lang"])


@query("""
WITH b AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS full_key, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') AS type_key FROM part),
f AS (SELECT full_key AS k, min(p_partkey) AS m FROM b GROUP BY 1), t AS (SELECT type_key AS k, min(p_partkey) AS m FROM b GROUP BY 1)
SELECT p.p_partkey AS id, coalesce(f.m, t.m) AS match, CASE WHEN f.m IS NOT NULL THEN 'exact' WHEN t.m IS NOT NULL THEN 'type' END AS strategy
FROM part p LEFT JOIN f ON trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') = f.k LEFT JOIN t ON trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') = t.k""")
def cascade_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    right = part.select("p_partkey", F.col("p_name").alias("r_name"), F.col("p_type").alias("r_type"))
    left = part.select(F.col("p_partkey").alias("id"), "p_name", "p_type")
    matched = joins.cascade(left, right, [("exact", text.slug(F.col("p_name")), text.slug(F.col("r_name"))), ("type", text.slug(F.col("p_type")), text.slug(F.col("r_type")))], "p_partkey")
    return matched.select("id", "match", "strategy")


@query("""
SELECT a.p_partkey AS id, b.s_suppkey AS supplier FROM (SELECT p_partkey, 'Supplier#' || lpad(p_partkey::VARCHAR, 9, '0') || ' ' || p_brand AS name FROM part) a
JOIN (SELECT s_suppkey, 'Supplier#' || lpad(s_suppkey::VARCHAR, 9, '0') AS name FROM supplier) b ON starts_with(a.name, b.name)""")
def prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("Supplier#"), F.lpad(F.col("key").cast("string"), 9, "0"))
    left = table(spark, sf_dir, "part").withColumn("key", F.col("p_partkey")).select(F.col("p_partkey").alias("id"), F.concat(name, F.lit(" "), "p_brand").alias("a"))
    right = table(spark, sf_dir, "supplier").withColumn("key", F.col("s_suppkey")).select(F.col("s_suppkey").alias("supplier"), name.alias("b"))
    return joins.prefix_match(left, right, "a", "b", 18).select("id", "supplier")


@query("""
SELECT e.event_id, m.event_id AS mark FROM (SELECT * FROM events WHERE event_type <> 'purchase') e
ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) m ON e.user_id = m.user_id AND e.ts >= m.ts""")
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    marks = events.filter("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("mark"))
    return joins.as_of(events.filter("event_type <> 'purchase'").select("event_id", "user_id", "ts"), marks, ["user_id"], "ts", "mark").select("event_id", "mark")


@query("""
WITH o AS (SELECT conv_id, turn, length(text) AS n, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS char_start FROM conversations)
SELECT conv_id, turn, char_start::BIGINT AS char_start, (char_start + n)::BIGINT AS char_end FROM o""")
def running_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = joins.with_offsets(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", 2)
    return turns.select("conv_id", "turn", F.col("char_start").cast("long"), F.col("char_end").cast("long"))


@query("SELECT conv_id, count(*) AS parts, md5(string_agg(text, chr(10) ORDER BY turn)) AS text FROM conversations GROUP BY 1")
def reassembled_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.reassembled(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text").withColumn("text", F.md5("text"))


@query("""
SELECT source, text_md5, min(doc_id) AS doc_id FROM (SELECT source, md5(text) AS text_md5, doc_id FROM documents) GROUP BY ALL""")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", F.md5("text").alias("text_md5"), "doc_id")
    return joins.first_per_key(docs, ["source", "text_md5"], ["doc_id"])


_UPSERT = "cur AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_nationkey < 15), inc AS (SELECT c_custkey AS k, -c_acctbal AS v FROM customer WHERE c_nationkey > 10)"


@query(f"WITH {_UPSERT} SELECT coalesce(i.k, c.k) AS k, CASE WHEN i.k IS NOT NULL THEN i.v ELSE c.v END AS v FROM cur c FULL JOIN inc i ON c.k = i.k")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    current = customer.filter("c_nationkey < 15").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return joins.upsert(current, customer.filter("c_nationkey > 10").select(F.col("c_custkey").alias("k"), (-F.col("c_acctbal")).alias("v")), ["k"])


@query(f"WITH {_UPSERT} SELECT coalesce(c.k, i.k) AS k, CASE WHEN c.k IS NOT NULL THEN c.v ELSE i.v END AS v FROM cur c FULL JOIN inc i ON c.k = i.k")
def upsert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    current = customer.filter("c_nationkey < 15").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return joins.upsert(current, customer.filter("c_nationkey > 10").select(F.col("c_custkey").alias("k"), (-F.col("c_acctbal")).alias("v")), ["k"], merge=False)


@query("SELECT DISTINCT o_custkey AS citing, l_suppkey AS cited FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey <> l_suppkey")
def citation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("citing"), F.col("l_suppkey").alias("key"))
    return joins.citation_edges(cited, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_suppkey").alias("case_id")))


@query("""
SELECT doc_id, regexp_matches(text, '(?i)shall not be (published|reported|disclosed)|identity of the (victim|child|prosecutrix) shall not')
   OR regexp_matches(text, '(?i)\\bCite\\s+this\\s+(article|document)\\b|\\bTry\\s+out\\s+our\\s+Premium\\s+Member\\b') AS excluded FROM documents""")
def excluded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", redaction.excluded(F.col("text")).alias("excluded"))


@query()
def redacted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", redaction.redact(F.col("text")).alias("r"))
    return docs.select("doc_id", F.md5("r.text").alias("text_md5"), *(F.coalesce(F.element_at("r.counts", k), F.lit(0)).alias(k) for k in redaction.RULES))


@query("""
SELECT doc_id, length(regexp_replace(text, '(^|[^0-9A-Za-z_])[0-9A-Za-z_.+-]+@[0-9A-Za-z_-]+\\.[0-9A-Za-z_.]{2,}', '\\1@@', 'g')) <> length(text) AS has_email FROM documents""")
def email_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = redaction.redact(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.element_at(r["counts"], "email") > 0, F.lit(False)).alias("has_email"))


def pick(number: Column, choices: Sequence[str | None]) -> Column:
    """The choice of a row, in turn by its number."""
    return F.get(F.array(*map(F.lit, choices)), F.pmod(number, F.lit(len(choices))).cast("int"))


def sql_pick(number: str, choices: Sequence[object]) -> str:
    """The same in SQL."""
    quoted = ("NULL" if c is None else "'" + c.replace("'", "''") + "'" if isinstance(c, str) else str(c) for c in choices)
    return f"([{', '.join(quoted)}])[({number}) % {len(choices)} + 1]"


# headings, and the section types that they begin
_SECTIONS = {
    "RATIO DECIDENDI\nThe court held that": "ratio_decidendi",
    "OBITER DICTA\nBy way of observation": "obiter_dicta",
    "ISSUES\n1. Whether the contract was valid?": "issues",
    "JUDGMENT\nDelivered by": "judgment",
    "FACTS\nThe brief facts": "facts",
    "ARGUMENTS\nLearned counsel": "arguments",
    "ANALYSIS\nWe have considered": "analysis",
    "CONCLUSION\nIn the result": "conclusion",
    "1. The appellant filed this case": "paragraph",
    "Some random legal text without section marker": "body",
    "IN THE SUPREME COURT OF INDIA\nCivil Appeal": "header",
    "PRECEDENTS CITED\n1. State": "precedents",
    "RELIEF SOUGHT\nThe petitioner": "relief",
    "RELEVANT STATUTORY PROVISIONS\nSection 302": "statutes",
    "PROCEDURAL HISTORY\nThe matter": "procedure",
}
_SECTION_TYPES = list(_SECTIONS.values())


@query(f"""
WITH t AS (SELECT p_partkey, {sql_pick("p_partkey", _SECTION_TYPES)} AS section_type, {sql_pick("p_partkey", [100, 75, 80, 90, 65, 70, 85, 95, 35, 30, 40, 60, 55, 50, 45])} AS priority FROM part)
SELECT p_partkey, section_type, priority, priority >= 70 AS important FROM t""")
def section_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part's text opens with a heading and goes on with its name."""
    texts = table(spark, sf_dir, "part").withColumn("t", F.concat(pick(F.col("p_partkey"), list(_SECTIONS)), F.lit(" "), F.col("p_name")))
    kind = classify.section_type(F.col("t"))
    return texts.select("p_partkey", kind.alias("section_type"), classify.section_priority(kind).alias("priority"), classify.is_important(kind).alias("important"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(t, '\\bnotwithstanding\\s+anything\\s+contained\\s+in\\b') THEN 'overriding' WHEN regexp_matches(t, '\\bshall\\s+not\\b|\\bno\\s+person\\s+shall\\b|\\bit\\s+shall\\s+be\\s+unlawful\\b') THEN 'prohibitory'
 WHEN regexp_matches(t, '\\bshall\\b') THEN 'mandatory' WHEN regexp_matches(t, '\\bmay\\b') THEN 'discretionary' WHEN regexp_matches(t, '\\bis\\s+deemed\\s+to\\b') THEN 'declaratory' ELSE 'general' END AS provision_type
FROM (SELECT doc_id, lower(text) AS t FROM documents)""")
def provision_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", classify.provision_type(F.col("text")).alias("provision_type"))


@query("""
WITH t AS (SELECT o_orderkey, o_orderdate AS d, CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y') WHEN 2 THEN strftime(o_orderdate, '%d.%m.%Y')
  WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M') WHEN 4 THEN strftime(o_orderdate, '%d-%b-%Y') WHEN 5 THEN strftime(o_orderdate, '%d %b, %Y') ELSE 'soon' END AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN raw <> 'soon' THEN strftime(d, '%Y-%m-%d') END AS iso FROM t""")
def parsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = ["dd/MM/yyyy", "dd-MM-yyyy", "dd.MM.yyyy", "yyyy-MM-dd'T'HH:mm", "dd-MMM-yyyy", "dd MMM, yyyy"]
    raw = F.lit("soon")
    for k, form in enumerate(forms):
        raw = F.when(F.col("o_orderkey") % 7 == k, F.date_format("o_orderdate", form)).otherwise(raw)
    return table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw")).withColumn("iso", extract.parse_date(F.col("raw")))


@query("""
WITH t AS (SELECT o_orderkey, year(o_orderdate) AS y, o_orderkey % 4 AS k FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN y || '-' || (y + 1) WHEN 1 THEN y || '-' || right((y + 1)::VARCHAR, 2) WHEN 2 THEN 'NA' ELSE '' END AS raw,
  CASE WHEN k < 2 THEN y || '-' || right((y + 1)::VARCHAR, 2) END AS year FROM t""")
def assessment_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, k = F.year("o_orderdate"), F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.concat(y, F.lit("-"), y + 1)).when(k == 1, F.concat(y, F.lit("-"), F.right((y + 1).cast("string"), F.lit(2)))).when(k == 2, "NA").otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw")).withColumn("year", extract.assessment_year(F.col("raw")))


_CITIES = ["NEW DELHI", "Mumbai", "kochi", "Nowhere", None]


@query(f"""
WITH t AS (SELECT c_custkey, c_name || coalesce(', ' || {sql_pick("c_custkey", _CITIES)}, '') AS raw, c_name, {sql_pick("c_custkey", ["New Delhi", "Mumbai", "Kochi", None, None])} AS known FROM customer)
SELECT c_custkey, CASE WHEN known IS NULL THEN raw ELSE c_name END AS party, coalesce(known, '') AS city FROM t""")
def parties_and_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat("c_name", F.coalesce(F.concat(F.lit(", "), pick(F.col("c_custkey"), _CITIES)), F.lit("")))
    return table(spark, sf_dir, "customer").select("c_custkey", extract.party_and_city(raw).alias("p")).select("c_custkey", "p.*")


@query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || ' Ltd' WHEN 1 THEN c_name ELSE 'In re ' || c_name END AS petitioner,
  CASE c_custkey % 3 WHEN 0 THEN 'State of ' || c_mktsegment WHEN 1 THEN c_mktsegment || ' vs. Z' ELSE '' END AS respondent FROM customer""")
def title_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 3
    title = (
        F.when(k == 0, F.concat("c_name", F.lit(" <b>Ltd</b> Versus  State of "), "c_mktsegment"))
        .when(k == 1, F.concat("c_name", F.lit(" v. "), "c_mktsegment", F.lit(" vs. Z")))
        .otherwise(F.concat(F.lit("In re "), "c_name"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", extract.parties(title).alias("p")).select("c_custkey", "p.*")


_ORDER_PAGES = "SELECT o_orderkey, year(o_orderdate) AS y, o_custkey % 9000 + 1000 AS n, o_custkey % 9 + 1 AS v, o_orderkey % 3 AS k FROM orders"


def _order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up volumes and pages of orders, as strings."""
    custkey = F.col("o_custkey")
    columns = {"y": F.year("o_orderdate"), "n": custkey % 9000 + 1000, "v": custkey % 9 + 1}
    return table(spark, sf_dir, "orders").select("o_orderkey", *(c.cast("string").alias(k) for k, c in columns.items()), (F.col("o_orderkey") % 3).alias("k"))


@query(f"""
WITH t AS ({_ORDER_PAGES})
SELECT o_orderkey, CASE k WHEN 0 THEN 'SCR ' || n || ' ' || y || ' ' || v WHEN 1 THEN y || ' INSC ' || n ELSE 'MANU TN ' || n || ' ' || y END AS alias_key,
  CASE k WHEN 0 THEN 'SCR ' || n || ' [' || y || '] (' || v || ')' WHEN 1 THEN y || ' INSC ' || n ELSE 'MANU/TN/' || n || '/' || y END AS graph_key,
  CASE k WHEN 0 THEN 'SCR' WHEN 1 THEN 'NEUTRAL' ELSE 'MANU' END AS type FROM t""")
def citation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("k") == 0, F.format_string("S.C.R. %s [%s] (%s)", "n", "y", "v")).when(F.col("k") == 1, F.format_string("%s  INSC %s", "y", "n")).otherwise(F.format_string("MANU/TN/%s/%s", "n", "y"))
    cited = _order_pages(spark, sf_dir).withColumn("raw", raw)
    return cited.select("o_orderkey", extract.alias_key(F.col("raw")).alias("alias_key"), extract.graph_key(F.col("raw")).alias("graph_key"), extract.citation_type(F.col("raw")).alias("type"))


@query(f"""
WITH t AS ({_ORDER_PAGES})
SELECT o_orderkey, unnest(['air', 'scc_parenthetical', 'neutral_sc', 'manu']) AS reporter,
  unnest(['AIR ' || y || ' SC ' || n, '(' || y || ') ' || v || ' SCC ' || n, y || ' INSC ' || n, 'MANU/TN/' || n || '/' || y]) AS raw FROM t""")
def extracted_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_string("see AIR %1$s SC %2$s; (%1$s) %3$s SCC %2$s, %1$s INSC %2$s and MANU/TN/%2$s/%1$s", "y", "n", "v")
    return _order_pages(spark, sf_dir).select("o_orderkey", F.explode_outer(extract.citations(text)).alias("c")).filter("c is not null").select("o_orderkey", "c.*")


@query("""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+', ''), '-+$', '')) AS slug FROM pages""")
def url_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))


@query()
def html_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


@query("""
SELECT doc_id::VARCHAR AS case_id, NULL::BIGINT AS chunk_index, TRUE AS box_aware, []::VARCHAR[] AS judges, n_chars AS char_end FROM documents""")
def published_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("case_id"), "text", F.lit("x").alias("chunk_index"), F.lit("false").alias("box_aware"), F.col("n_chars").alias("char_end"), F.lit("drop").alias("r2_key"))
    return schemas.as_published(raw, schemas.CASE_LAW).select("case_id", "chunk_index", "box_aware", "judges", "char_end")


@query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'central' WHEN 1 THEN 'state' ELSE '' END AS jurisdiction, CASE c_custkey % 3 WHEN 1 THEN 'kerala' ELSE '' END AS state,
  CASE c_custkey % 3 WHEN 1 THEN 'regulatory' ELSE 'legislation' END AS instrument_type, c_custkey % 3 = 0 AS in_force FROM customer""")
def repaired_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = {"jurisdiction": ["central", "regulatory", "state"], "category": ["central", "regulatory", "state"], "state": ["central", "Kerala", ""], "act_status": ["in_force", "repealed", "Spent"]}
    rows = table(spark, sf_dir, "customer").select("c_custkey", *(pick(k, v).alias(name) for name, v in raw.items()))
    return schemas.taxonomy(rows).select("c_custkey", "jurisdiction", "state", "instrument_type", "in_force")


@query("""
WITH t AS (SELECT o_orderkey, o_orderkey % 3 AS k, o_orderdate AS d, o_custkey % 900 + 1 AS n FROM orders)
SELECT o_orderkey, CASE WHEN k < 2 THEN strftime(d, '%Y-%m-%d') END AS decision_date, CASE k WHEN 0 THEN 'WRIT PETITION' WHEN 1 THEN 'CRIMINAL APPEAL' END AS case_type,
  CASE WHEN k < 2 THEN n || ' of ' || year(d) END AS case_number, CASE k WHEN 0 THEN 'WRIT' WHEN 1 THEN 'CRIMINAL' END AS jurisdiction,
  CASE k WHEN 0 THEN 'DIVISION BENCH' END AS bench_type, CASE k WHEN 0 THEN 'ALLOWED' WHEN 1 THEN 'DISMISSED' END AS disposal_status FROM t""")
def judgment_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgments of orders: two kinds of head, and texts that say nothing."""
    n, y, k = (F.col("o_custkey") % 900 + 1).cast("string"), F.year("o_orderdate").cast("string"), F.col("o_orderkey") % 3
    writ = F.concat(F.lit("WRIT PETITION No. "), n, F.lit(" of "), y, F.lit("\nDATE : "), F.date_format("o_orderdate", "d MMMM yyyy"), F.lit("\nDivision Bench\nThe petition is allowed."))
    appeal = F.concat(F.lit("Criminal Appeal No. "), n, F.lit(" of "), y, F.lit("\nDATED : "), F.date_format("o_orderdate", "d/M/yyyy"), F.lit("\nThe appeal is dismissed."))
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == 0, writ).when(k == 1, appeal).otherwise(F.col("o_orderpriority")).alias("t"))
    found = texts.select("o_orderkey", judgments.metadata(F.col("t")).alias("m"))
    return found.select("o_orderkey", "m.decision_date", "m.case_type", "m.case_number", "m.jurisdiction", "m.bench_type", "m.disposal_status")


@query("""
SELECT CASE WHEN o_orderkey % 7 < 2 THEN 'DISPOSED OF' ELSE 'DISMISSED' END AS disposition, o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey % 7 < 4 GROUP BY ALL HAVING count(*) >= 10""")
def disposition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = pick(F.col("o_orderkey"), ["disposed off", "DISPOSAL no costs", "Dismissed", "DISSMISSED", "HEARD", None, "12-3 internal"])
    kinds = table(spark, sf_dir, "orders").select(judgments.disposition(raw).alias("disposition"), "o_orderstatus")
    return audit.facet(kinds.filter("disposition is not null"), "disposition", "o_orderstatus").filter("n >= 10")


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 2 THEN 'Orissa High Court' WHEN 3 THEN NULL ELSE 'Madras High Court' END AS court, CASE c_custkey % 4 WHEN 2 THEN 'orissa' WHEN 3 THEN NULL ELSE 'madras' END AS slug FROM customer""")
def court_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    case_id = F.concat(pick(F.col("c_custkey"), ["HCMA", "HCMD", "ODHC", "ZZZZ"]), F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", judgments.court_name(case_id).alias("court")).withColumn("slug", judgments.court_slug(F.col("court")))


@query()
def chunked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chunks = chunking.chunk(docs).join(docs.select("doc_id", "source"), "doc_id")
    typed = chunking.with_context(chunks, F.concat(F.lit("Document "), F.col("doc_id").cast("string")), F.lit(""), F.lit(0), F.col("source"))
    return typed.select("doc_id", "chunk_index", "total_chunks", "char_start", "char_end", "section_type", "section_priority", F.md5("text").alias("text_md5"))


@query("""
WITH t AS (SELECT p_partkey, length(p_name) + 20 AS begin_1 FROM part)
SELECT p_partkey, unnest(['preamble', 'part_heading', 'chapter_heading', 'section', 'section', 'schedule']) AS type, unnest(['An Act to', 'I', 'II', '1', '2A', 'FIRST SCHEDULE']) AS number,
  unnest([0, begin_1, begin_1 + 8, begin_1 + 20, begin_1 + 35, begin_1 + 74])::INT AS char_start, unnest([begin_1, begin_1 + 8, begin_1 + 20, begin_1 + 35, begin_1 + 74, begin_1 + 88])::INT AS char_end,
  unnest([NULL, NULL, 'II', 'II', 'II', 'II']) AS chapter, unnest([NULL, 'I', 'I', 'I', 'I', 'I']) AS part FROM t""")
def act_provisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts of parts, each with the part's name in its long title."""
    text = F.concat(F.lit("An Act to provide "), "p_name", F.lit(".\nPART I \nCHAPTER II \n1. Short title\n**2A. Second thing**\n> 1. Subs. by Act\nFIRST SCHEDULE"))
    found = chunking.provisions(table(spark, sf_dir, "part").select("p_partkey", text.alias("text")), "p_partkey")
    return found.select("p_partkey", "type", "number", F.col("char_start").cast("int"), F.col("char_end").cast("int"), "chapter", "part")


# the operators whose pinned cases stand above as literals, over whole tables


@query()
def document_section_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = table(spark, sf_dir, "documents").select("doc_id", classify.section_type(F.col("text")).alias("section_type"))
    kind = F.col("section_type")
    return typed.withColumns({"priority": classify.section_priority(kind), "important": classify.is_important(kind)})


# documents' whole texts, each with two citations at its end, of which SQL knows what they are
_CITED = "SELECT doc_id, 1950 + doc_id % 70 AS y, doc_id % 900 + 1 AS n, doc_id % 9 + 1 AS v FROM documents"


def _cited_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    y, n, v = ((x).cast("string") for x in (1950 + key % 70, key % 900 + 1, key % 9 + 1))
    said = F.concat(F.lit("\nSee A.I.R. and AIR "), y, F.lit(" SC "), n, F.lit(" and ("), y, F.lit(") "), v, F.lit(" SCC "), n, F.lit("."))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), said).alias("text"))


@query(f"SELECT doc_id, unnest(['air', 'scc_parenthetical']) AS reporter, unnest(['AIR ' || y || ' SC ' || n, '(' || y || ') ' || v || ' SCC ' || n]) AS raw FROM ({_CITED})")
def cited_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _citations(_cited_documents(spark, sf_dir))


@query(f"""SELECT doc_id, unnest(['AIR ' || y || ' SC ' || n, '(' || y || ') ' || v || ' SCC ' || n]) AS raw, unnest(['AIR ' || y || ' SC ' || n, y || ' ' || v || ' SCC ' || n]) AS alias_key,
  unnest(['AIR ' || y || ' SC ' || n, '(' || y || ') ' || v || ' SCC ' || n]) AS graph_key, unnest(['AIR', 'SCC']) AS type FROM ({_CITED})""")
def cited_document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(cited_documents(spark, sf_dir))


@query()
def document_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _citations(table(spark, sf_dir, "documents"))


@query()
def document_citation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(document_citations(spark, sf_dir))


def _citations(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.explode_outer(extract.citations(F.col("text"))).alias("c")).filter("c is not null").select("doc_id", "c.*")


def _keys(found: DataFrame) -> DataFrame:
    raw = F.col("raw")
    return found.select("doc_id", "raw", extract.alias_key(raw).alias("alias_key"), extract.graph_key(raw).alias("graph_key"), extract.citation_type(raw).alias("type"))


@query()
def document_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", judgments.metadata(F.col("text")).alias("m"))
    return found.select("doc_id", "m.decision_date", "m.case_type", "m.case_number", "m.jurisdiction", "m.bench_type", "m.disposal_status")


@query("""
WITH t AS (SELECT doc_id, length(replace(coalesce(text, ''), chr(10), ' ')) AS n, doc_id % 40 + 1 AS s FROM documents), p AS (SELECT *, length('1. Head ') + n + 1 AS s1, length(s::VARCHAR) AS w FROM t)
SELECT doc_id, unnest(['section', 'chapter_heading', 'section']) AS type, unnest(['1', 'IV', s || 'A']) AS number, unnest([80, 40, 80])::INT AS priority, unnest([0, s1, s1 + 11])::INT AS char_start, unnest([s1, s1 + 11, s1 + 11 + w + 7])::INT AS char_end,
  unnest([NULL, 'IV', 'IV']) AS chapter, NULL::VARCHAR AS part FROM p""")
def provisions_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' whole texts as the first section of an act, on one line, and a chapter with another behind it."""
    line = F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))
    acts = F.concat(F.lit("1. Head "), line, F.lit("\nCHAPTER IV\n"), (F.col("doc_id") % 40 + 1).cast("string"), F.lit("A. Last"))
    found = chunking.provisions(table(spark, sf_dir, "documents").select("doc_id", acts.alias("text")), "doc_id")
    return found.select("doc_id", "type", "number", "priority", F.col("char_start").cast("int").alias("char_start"), F.col("char_end").cast("int").alias("char_end"), "chapter", "part")


@query()
def document_provisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.provisions(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


@query()
def document_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.facet(table(spark, sf_dir, "documents").select(judgments.disposition(F.col("text")).alias("disposition")), "disposition")


@query()
def document_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", extract.parties(F.col("text")).alias("p")).select("doc_id", F.md5("p.petitioner").alias("petitioner_md5"), F.md5("p.respondent").alias("respondent_md5"))


@query("""
SELECT CASE doc_id % 3 WHEN 0 THEN 'DISPOSED OF' WHEN 1 THEN 'DISMISSED AS INFRUCTUOUS' END AS disposition, count(*) AS n FROM documents GROUP BY 1""")
def dispositions_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's disposition in a clerk's words, with its source behind it; a third say nothing."""
    key = F.col("doc_id") % 3
    raw = F.when(key == 0, F.concat(F.lit("Disposed off, "), F.substring("source", 1, 20))).when(key == 1, F.concat(F.lit("dismised as infractuous "), F.substring("source", 1, 20))).otherwise("12-3 internal")
    return audit.facet(table(spark, sf_dir, "documents").select(judgments.disposition(raw).alias("disposition")), "disposition")


@query()
def document_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("jurisdiction"), F.col("lang").alias("category"), F.col("source").alias("state"), F.lit("in_force").alias("act_status"))
    return schemas.taxonomy(docs).select("doc_id", "jurisdiction", "state", "instrument_type", "in_force")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", extract.parse_date(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("iso"))


@query("SELECT o_orderkey, year(o_orderdate) || '-' || right((year(o_orderdate) + 1)::VARCHAR, 2) AS year FROM orders")
def order_assessment_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", extract.assessment_year(F.concat_ws("-", year, year + 1)).alias("year"))


@query("SELECT c_custkey, c_name AS party, '' AS city FROM customer")
def customer_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", extract.party_and_city(F.col("c_name")).alias("p")).select("c_custkey", "p.*")


@query("SELECT c_custkey, NULL::VARCHAR AS court, NULL::VARCHAR AS slug FROM customer")
def customer_court_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").select("c_custkey", judgments.court_name(F.col("c_name")).alias("court"))
    return named.withColumn("slug", judgments.court_slug(F.col("court")))


_TOKENS = f"list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'), lambda t: NOT list_contains([{', '.join(repr(w) for w in _STOPWORDS.split())}], t) AND length(t) <= 40)"
_BM25 = f"""d AS (SELECT doc_id, {_TOKENS} AS t FROM documents), tf AS (SELECT doc_id, len(t) AS len, unnest(t) AS token FROM d),
c AS (SELECT doc_id, token, len, count(*) AS tf FROM tf GROUP BY ALL), q AS (SELECT item_id, unnest(list_distinct({_TOKENS})) AS token FROM benchmark),
df AS (SELECT token, count(*) AS df FROM c GROUP BY 1), n AS (SELECT count(*) AS n FROM documents),
s AS (SELECT item_id AS query_id, doc_id, sum(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / 256)) * ln(1 + (n - df + 0.5) / (df + 0.5))) AS score FROM q JOIN c ON q.token = c.token JOIN df ON df.token = c.token, n GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s)"""


def _bm25(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return retrieval.bm25(retrieval.postings(docs, "doc_id", "text"), docs.count(), queries, k, "doc_id")


@query(f"WITH {_BM25} SELECT query_id, doc_id, rank::INT AS rank, round(score, 4) AS score FROM r WHERE rank <= 5")
def bm25_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bm25(spark, sf_dir, 5).select("query_id", "doc_id", "rank", F.round("score", 4).alias("score"))


@query(f"""WITH {_BM25}, b AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS rank FROM r WHERE rank <= 50), u AS (SELECT query_id, doc_id, rank FROM r WHERE rank <= 50 UNION ALL SELECT query_id, doc_id, rank FROM b)
SELECT query_id, doc_id, round(sum(1 / (60 + rank)), 9) AS score FROM u GROUP BY ALL""")
def fused_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_score = _bm25(spark, sf_dir, 50)
    by_id = by_score.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("doc_id")))
    return retrieval.fused([by_score, by_id], "query_id", "doc_id").select("query_id", "doc_id", F.round("score", 9).alias("score"))


@query("""
WITH w AS (SELECT s_suppkey AS id, unnest(regexp_extract_all(lower(s_name), '[a-z0-9]+')) AS w FROM supplier), g AS (SELECT id, list_distinct(list(gram)) AS t FROM (
  SELECT id, unnest(list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))) AS gram FROM w) GROUP BY id),
p AS (SELECT a.id AS query_id, b.id AS id, len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) AS s FROM g a JOIN g b ON a.id % 50 = 0)
SELECT query_id, id, round(s, 6) AS similarity FROM p WHERE s >= 0.8""")
def trigram_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    asked = names.filter("id % 50 = 0").select(F.col("id").alias("query_id"), F.col("name").alias("query"))  # a stated query set against all rows
    found = retrieval.trigram_search(names, asked, "id", "name", "query_id", "query", 0.8)
    return found.select("query_id", "id", F.round("similarity", 6).alias("similarity"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type")
