"""Registered queries of acts: texts are built of a table's columns, so that SQL can say what is in them without reading them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import legislation
from ..operators import footnotes, matches, provisions
from ..sources import paged
from .queries import query, spread, table

_NOTES = "n AS (SELECT p_partkey, p_name, p_brand, p_type, p_size AS a, p_size + 7 AS b, p_partkey % 90 + 1 AS no, 1950 + p_partkey % 60 AS y, p_partkey % 2 = 1 AS odd FROM part)"


@query(f"""
WITH {_NOTES}, rows AS (
  SELECT p_partkey, a::VARCHAR AS section_number, p_name AS section_title, 1 AS footnote_id, 'Ins. by Act ' || (no + 1) || ' of ' || y || ', s. 3' AS footnote_text, 'insertion' AS footnote_type, 'Act ' || (no + 1) || ' of ' || y AS by_act, NULL AS original_text, NULL AS effective_date FROM n
  UNION ALL SELECT p_partkey, b::VARCHAR, p_type, 2, CASE WHEN odd THEN 'Omitted by Act 7 of 2001' ELSE 'vide notification No. ' || no || '/' || y END, CASE WHEN odd THEN 'omission' ELSE 'note' END, CASE WHEN odd THEN 'Act 7 of 2001' END, NULL, NULL FROM n
  UNION ALL SELECT p_partkey, a::VARCHAR, p_name, NULL, 'Subs. by Act ' || no || ' of ' || y || ', for "' || p_brand || '" (w.e.f. 1-' || (a % 12 + 1) || '-' || y || ').', 'substitution', 'Act ' || no || ' of ' || y, p_brand, '1-' || (a % 12 + 1) || '-' || y FROM n
  UNION ALL SELECT p_partkey, b::VARCHAR, p_type, NULL, 'Ins. by Act ' || (no + 1) || ' of ' || y || ', s. 3', 'insertion', 'Act ' || (no + 1) || ' of ' || y, NULL, NULL FROM n
  UNION ALL SELECT p_partkey, b::VARCHAR, p_type, NULL, 'vide notification No. ' || no || '/' || y || chr(10) || '2. Omitted by Act 7 of 2001', 'note', NULL, NULL, NULL FROM n WHERE odd)
SELECT p_partkey, section_number, section_title, footnote_id::BIGINT AS footnote_id, footnote_text, footnote_type, by_act, original_text, effective_date FROM rows""")
def act_footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sections a part, with marks, an amendment, and notes that are numbered; of note 2 the last counts."""
    no, year = F.col("p_partkey") % 90 + 1, 1950 + F.col("p_partkey") % 60
    text = F.concat(
        F.lit("**"), "p_size", F.lit(". "), "p_name", F.lit(".** Body of it 1[word] here.\nSubs. by Act "), no, F.lit(" of "), year, F.lit(', for "'), "p_brand", F.lit('" (w.e.f. 1-'), F.col("p_size") % 12 + 1, F.lit("-"), year,
        F.lit(").\n**Section "), F.col("p_size") + 7, F.lit(". "), "p_type", F.lit(" .-** More 2[word] and 9[none].\n1. Ins. by Act "), no + 1, F.lit(" of "), year, F.lit(", s. 3\n2. vide notification No. "), no, F.lit("/"), year,
        F.when(F.col("p_partkey") % 2 == 1, "\n2. Omitted by Act 7 of 2001\n").otherwise("\n"),
    )
    return footnotes.act_footnotes(spread(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", text.alias("text")), "p_partkey").drop("at")


@query(f"""
WITH {_NOTES}, rows AS (
  SELECT p_partkey, 1 AS id, 'Subs. by Act ' || no || ' of ' || y || ' for ''' || p_brand || '''' AS text, 'substitution' AS type, 'Act ' || no || ' of ' || y AS by_act, p_brand AS original_text FROM n
  UNION ALL SELECT p_partkey, 2, p_type || ' added', 'insertion', NULL, NULL FROM n
  UNION ALL SELECT p_partkey, 10 + a, 'See ' || p_name, 'note', NULL, NULL FROM n)
SELECT p_partkey, id::BIGINT AS id, text, type, by_act, original_text FROM rows""")
def structured_footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    no, year = F.col("p_partkey") % 90 + 1, 1950 + F.col("p_partkey") % 60
    text = F.concat(F.col("p_name"), F.lit("\n[Footnotes]\n1. Subs. by  Act "), no, F.lit(" of "), year, F.lit(" for '"), "p_brand", F.lit("'\n2. "), "p_type", F.lit("\nadded\n"), F.col("p_size") + 10, F.lit(". See "), "p_name", F.lit("\n"))
    return spread(table(spark, sf_dir, "part")).select("p_partkey", F.inline(footnotes.structured_footnotes(text)))


# acts of parts: a heading, a definition with as many clauses as the size says, a small section, and one in paragraphs
_CLAUSES = "list_transform(range(1, p_size % 3 + 3), lambda i: '(' || chr((96 + i)::INT) || ') ' || repeat(p_brand || ' ', 60) || 'means' || chr(10))"
_ACT = f"""
t AS (SELECT p_partkey, p_size % 3 + 2 AS k, p_size % 5 + 2 AS m, p_name, p_type, 'An Act to make ' || p_name || chr(10) || chr(10) || repeat('w ', 50) || chr(10) AS preamble, 'CHAPTER II' || chr(10) || p_name || chr(10) || chr(10) AS heading,
  '1. Definitions.—In this' || chr(10) AS opening, {_CLAUSES} AS clauses, '2. ' || p_type || '.—[Omitted by Act 3 of 1999]' || chr(10) AS small, '3A. ' || p_brand || '.—' || chr(10) || chr(10) AS long_title, p_brand, length(p_brand) * 60 + 60 AS bulk FROM part),
a AS (SELECT *, array_to_string(clauses, '') AS definitions, array_to_string(list_transform(range(m), lambda i: repeat(p_brand || '-', 60)), chr(10) || chr(10)) AS paragraphs FROM t)"""


def _acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    clause = F.transform(F.sequence(F.lit(1), size % 3 + 2), lambda i: F.concat(F.lit("("), F.char(96 + i), F.lit(") "), F.repeat(F.concat("p_brand", F.lit(" ")), 60), F.lit("means\n")))
    paragraphs = F.transform(F.sequence(F.lit(1), size % 5 + 2), lambda _: F.repeat(F.concat("p_brand", F.lit("-")), 60))
    text = F.concat(
        F.lit("An Act to make "), "p_name", F.lit("\n\n"), F.repeat(F.lit("w "), 50), F.lit("\nCHAPTER II\n"), "p_name", F.lit("\n\n1. Definitions.—In this\n"), F.array_join(clause, ""), F.lit("2. "), "p_type", F.lit(".—[Omitted by Act 3 of 1999]\n3A. "), "p_brand",
        F.lit(".—\n\n"), F.array_join(paragraphs, "\n\n"),
    )
    return spread(table(spark, sf_dir, "part"), "p_partkey").select(F.col("p_partkey").alias("act_id"), text.alias("text"))


@query(f"""
WITH {_ACT}, rows AS (
  SELECT p_partkey, 1 AS n, 'preamble' AS type, '' AS number, 'Preamble' AS title, 65 AS priority, '' AS chapter, '' AS chapter_title, FALSE AS is_repealed, preamble AS body FROM a
  UNION ALL SELECT p_partkey, 2, 'chapter_heading', 'II', p_name, 30, 'II', p_name, FALSE, heading FROM a
  UNION ALL SELECT p_partkey, 3, 'definitions', '1', 'Definitions', 90, 'II', p_name, FALSE, opening || definitions FROM a
  UNION ALL SELECT p_partkey, 4, 'section', '2', p_type, 80, 'II', p_name, TRUE, small FROM a
  UNION ALL SELECT p_partkey, 5, 'section', '3A', p_brand, 80, 'II', p_name, FALSE, long_title || paragraphs FROM a)
SELECT p_partkey AS act_id, type, number, title, priority, chapter, chapter_title, is_repealed, (sum(length(body)) OVER w - length(body))::INT AS char_start, (sum(length(body)) OVER w)::INT AS char_end, md5(body) AS body_md5
FROM rows WINDOW w AS (PARTITION BY p_partkey ORDER BY n)""")
def act_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = provisions.boundaries(_acts(spark, sf_dir))
    return found.select("act_id", "type", "number", "title", "priority", "chapter", "chapter_title", "is_repealed", "char_start", "char_end", F.md5("body").alias("body_md5"))


# a clause has bulk + 9 characters; definitions are long enough to be cut when they have over 1500, paragraphs fill up to 1500
@query(f"""
WITH {_ACT}, s AS (SELECT *, length(preamble) AS s1, length(heading) + length(opening) + length(definitions) + length(small) AS n2, length(long_title) + length(paragraphs) AS n3, greatest(1, (1502 - 0) // (bulk + 2)) AS fit FROM a),
defs AS (SELECT p_partkey, s1, heading || opening AS head, definitions || small AS rest, clauses, small, n2, k FROM s),
whole AS (SELECT p_partkey, '1' AS number, '' AS sub_section, 'definitions' AS provision_type, s1 AS char_start, head || rest AS text FROM defs WHERE n2 <= 1500
  UNION ALL SELECT p_partkey, '1', '', 'section', s1, trim(head, E' \\n') FROM defs WHERE n2 > 1500
  UNION ALL SELECT p_partkey, '1', '(' || chr((96 + i)::INT) || ')', 'definition_clause', s1 + length(head) + (i - 1) * length(clauses[1]), trim(clauses[i] || CASE WHEN i = k THEN small ELSE '' END, E' \\n') FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM defs) WHERE n2 > 1500
  UNION ALL SELECT p_partkey, '', '', 'preamble', 0, preamble FROM s),
lines AS (SELECT p_partkey, s1 + n2 AS start, 0 AS j, '3A. ' || p_brand || '.—' AS t, n3, 0 AS pos FROM s
  UNION ALL SELECT p_partkey, s1 + n2, j + 1, repeat(p_brand || '-', 60), n3, (length(long_title) + j * (bulk + 2)) FROM (SELECT *, unnest(range(m)) AS j FROM s)),
groups AS (SELECT l.*, CASE WHEN j = 0 THEN 0 ELSE (j - first_fit + fit - 1) // fit END AS g FROM lines l JOIN (SELECT p_partkey, (1500 - length('3A. ' || p_brand || '.—')) // (bulk + 2) AS first_fit, (1500 + 2) // (bulk + 2) AS fit FROM s) USING (p_partkey)),
paras AS (SELECT p_partkey, '3A' AS number, '' AS sub_section, 'section' AS provision_type, min(start + pos)::INT AS char_start, string_agg(t, chr(10) || chr(10) ORDER BY j) AS text FROM groups WHERE n3 > 1500 GROUP BY p_partkey, greatest(g, 0)
  UNION ALL SELECT p_partkey, '3A', '', 'section', s1 + n2, long_title || paragraphs FROM s WHERE n3 <= 1500)
SELECT p_partkey AS act_id, number, sub_section, provision_type, char_start::INT AS char_start, md5(text) AS text_md5 FROM (SELECT * FROM whole UNION ALL SELECT * FROM paras)""")
def act_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heading goes with the definitions, the small section too; what is long is cut at clauses or filled up by paragraphs."""
    found = provisions.pieces(provisions.merged(provisions.boundaries(_acts(spark, sf_dir))))
    return found.select("act_id", "number", "sub_section", "provision_type", "char_start", F.md5("text").alias("text_md5"))


@query("""
WITH t AS (SELECT p_partkey, p_name, p_type || chr(10) AS before, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', chr(10) || '  ') ELSE replace(p_name, ' ', '-') END AS written FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 OR NOT contains(p_name, ' ') THEN length(before) END AS "begin", CASE WHEN p_partkey % 3 < 2 OR NOT contains(p_name, ' ') THEN length(before) + length(written) END AS "end" FROM t""")
def found_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part's name in a text that breaks its lines elsewhere; places are those of the text as it is."""
    kind = F.col("p_partkey") % 3
    written = F.when(kind == 0, F.col("p_name")).when(kind == 1, F.replace("p_name", F.lit(" "), F.lit("\n  "))).otherwise(F.replace("p_name", F.lit(" "), F.lit("-")))
    texts = spread(table(spark, sf_dir, "part")).select("p_partkey", "p_name", F.concat("p_type", F.lit("\n"), written, F.lit(" "), "p_brand").alias("text"))
    return texts.select("p_partkey", matches.find_tolerant(F.col("p_name"), F.col("text")).alias("f")).select("p_partkey", F.col("f.begin").cast("long").alias("begin"), F.col("f.end").cast("long").alias("end"))


@query("""
WITH o AS (SELECT conv_id, turn, coalesce(length(text), 0) AS n, coalesce(sum(coalesce(length(text), 0) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM conversations)
SELECT conv_id, turn, pos AS "begin", pos + n AS "end" FROM o WHERE pos < 120 AND pos + n > 40""")
def spans_of_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of each conversation that lie within characters 40 to 120 of all of it."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))).alias("spans"))
    index = turns.withColumn("index", matches.span_index(F.col("spans")))
    hit = F.filter("index", lambda s: F.array_contains(F.transform(matches.spans_between(F.col("index"), F.lit(40), F.lit(120)), lambda x: x["turn"]), s["span"]["turn"]))
    return index.select("conv_id", F.explode(hit).alias("s")).select("conv_id", "s.span.turn", F.col("s.begin").cast("long").alias("begin"), F.col("s.end").cast("long").alias("end"))


@query("""
WITH t AS (SELECT p_partkey, p_brand, upper(p_name[1]) || p_name[2:] AS name, p_size, 1950 + p_partkey % 60 AS y, p_partkey % 90 + 1 AS no FROM part)
SELECT p_partkey, 'the State of Kerala' AS territorial_extent, '1-' || (p_size % 12 + 1) || '-' || y AS commencement, no::VARCHAR AS act_number, y::INT AS act_year, 'Home Affairs' AS ministry,
  'An Act to make ' || p_brand || '.' AS long_title, ['Indian Evidence Act, ' || y, 'Old Water Act ' || (y - 10)] AS acts_referenced, ['Old Water Act ' || (y - 10)] AS repeals, ['Ins. by Act ' || no || ' of ' || y || ', s. ' || p_size] AS amendment_notes,
  ['board', lower(p_brand)] AS defined_terms, ['30 days', p_size || ' years'] AS limitation_periods FROM t""")
def act_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts of parts that say what they are, where and when they hold, what they refer to, change and repeal."""
    no, year, size = (x.cast("string") for x in (F.col("p_partkey") % 90 + 1, 1950 + F.col("p_partkey") % 60, F.col("p_size")))
    text = F.concat(
        F.lit("ACT NO. "), no, F.lit(" OF "), year, F.lit("\nAn Act to make "), "p_brand", F.lit(".\nMinistry of Home Affairs, Delhi\n1. It extends to the State of Kerala. It shall come into force on 1-"), F.col("p_size") % 12 + 1, F.lit("-"), year,
        F.lit(".\n2. See the Indian Evidence Act, "), year, F.lit(" [Ins. by Act "), no, F.lit(" of "), year, F.lit(", s. "), size, F.lit("]; this repeals the Old Water Act "), (1940 + F.col("p_partkey") % 60).cast("string"),
        F.lit('. "Board" means one, "'), "p_brand", F.lit('" means another, within a period of 30 days or within '), size, F.lit(" years"),
    )
    texts = spread(table(spark, sf_dir, "part")).select("p_partkey", text.alias("t"))
    m = texts.select("p_partkey", legislation.act_metadata(F.col("t")).alias("m"), legislation.section_metadata(F.col("t"), F.lit("definitions"), F.lit("2")).alias("s"))
    return m.select(
        "p_partkey", *(F.col("m")[c].alias(c) for c in ("territorial_extent", "commencement", "act_number", "act_year")), F.col("m.enacting.ministry").alias("ministry"), F.col("m.enacting.long_title").alias("long_title"),
        *(F.col("m")[c].alias(c) for c in ("acts_referenced", "repeals", "amendment_notes")), F.col("s.defined_terms").alias("defined_terms"), F.col("s.limitation_periods").alias("limitation_periods"),
    )


@query("""
WITH t AS (SELECT p_partkey // 4 AS handle, p_partkey AS k, p_partkey % 4 AS m, p_brand, p_name, p_size FROM part),
x AS (SELECT handle, k, CASE m WHEN 0 THEN p_size || '. ' || p_brand WHEN 1 THEN p_size || '.' WHEN 2 THEN p_brand ELSE '' END AS head, CASE WHEN m < 3 THEN p_name || ' & more' || chr(10) || 'line[' || p_size || ']' ELSE '' END AS body, CASE WHEN m < 2 THEN chr(10) || '[Footnotes]' || chr(10) || p_size || '. Subs. by ' || p_brand ELSE '' END AS notes FROM t),
s AS (SELECT handle, k, array_to_string(list_filter([head, body, notes], lambda p: p <> ''), chr(10)) AS text FROM x)
SELECT handle::VARCHAR AS handle, count(*) AS sections, md5(string_agg(text, chr(10) || chr(10) ORDER BY k)) AS text_md5 FROM s WHERE text <> '' GROUP BY 1""")
def act_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four parts make an act of HTML sections, the last of them empty."""
    m, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    content = F.concat(F.lit("<p>"), "p_name", F.lit(" &amp; more<br/>line<sup>"), size, F.lit("</sup>  </p>"))
    sections = table(spark, sf_dir, "part").select(
        F.floor(F.col("p_partkey") / 4).cast("string").alias("handle"), F.col("p_partkey").alias("order"), F.when(m < 2, size).alias("section_no"), F.when((m == 0) | (m == 2), F.col("p_brand")).otherwise("").alias("label"),
        F.when(m < 3, content).alias("content"), F.when(m < 2, F.concat(size, F.lit(". Subs. by <i>"), "p_brand", F.lit("</i><br>"))).otherwise("<hr/>").alias("footnote"),
    )
    return paged.act_texts(sections).select("handle", "sections", F.md5("text").alias("text_md5"))
