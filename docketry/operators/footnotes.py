"""Footnotes of acts: amendment notes with what they changed, and the section that each stands in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.redaction import _let
from ..functions.text import strip
from .matches import as_of_latest, match_table

# Headers of sections; amendments and notifications in a text; numbered notes and their marks.  Lines end in a newline alone.
HEADER = r"(?md)^\*{1,2}(?:Section\s+)?(\d+[A-Z]?(?:\.\d+)?)\.\s*([^*\n]{0,120})"
AMENDMENT = r"(?i)(Subs\.|Omitted|Ins\.|Rep\.|Added|Re-?numbered(?:\s+as\s[^,\n]+)?)\s+by\s+(Act\s+\d+\s+of\s+\d{4})[^\n]{0,300}"
NOTIFICATION = r"(?i)vide\s+notification\s+No\.\s*[\w\s./]+"
NUMBERED = r"(?md)^(\d+)[.\s]\s*(.+)"
MARK = r"(\d+)\["
REPLACED = r"(?i),\s*for\s+\"([^\"]+)\""
EFFECTIVE = r"(?i)w\.e\.f\.\s*([\d]+-[\d]+-\d{4})"
#: Characters that a stored note has at most, and that a numbered note has more than.
MOST, LEAST = 2000, 10
# Types of a parsed amendment by how its first word begins, and of a structured note by what it holds, tried in this order.
BY_OPENING = [("subs", "substitution"), ("omit", "omission"), ("ins", "insertion"), ("rep", "repeal"), ("add", "addition")]
BY_CONTENT = [(["subs.", "substituted"], "substitution"), (["ins.", "inserted", "added"], "insertion"), (["omitted", "rep.", "repealed"], "omission"), (["renumbered"], "renumbering")]
# A block of notes, and one note of it.
BLOCK = r"(?is)\[Footnotes?\]\s*(.*)$"
ENTRY = r"(?s)(\d+)\.\s+(.*?)(?=\n\d+\.\s|\z)"

def opening_type(prefix: Column) -> Column:
    """Type of an amendment by its first word."""
    lower, out = F.lower(prefix), F.when(F.lower(prefix).contains("number"), "renumbering").otherwise("note")
    for opening, kind in reversed(BY_OPENING):
        out = F.when(lower.startswith(opening), kind).otherwise(out)
    return out


def content_type(note: Column) -> Column:
    """Type of a structured note by the words it holds; ``note`` where it holds none of them."""
    lower, out = F.lower(note), F.lit("note")
    for words, kind in reversed(BY_CONTENT):
        holds = F.lit(False)
        for w in words:
            holds = holds | lower.contains(w)
        out = F.when(holds, kind).otherwise(out)
    return out


def act_footnotes(acts: DataFrame, id: str = "act_id", text: str = "text") -> DataFrame:
    """Footnotes of whole acts: section_number, section_title, footnote_id, footnote_text, footnote_type, by_act, original_text, effective_date, ``at``.

    Three sources, in this order: numbered notes where a mark refers to them (the last
    note of a number counts; it must amend or notify), amendments in the text, and
    notifications in it.  Each belongs to the latest section header at or before it.  Of notes with the
    same text in the same section the first is kept.  Acts without notes, and null texts,
    have no rows; rows of the same id count as one act only if their texts are put together before.
    """
    kinds = {"header": (HEADER, 2), "numbered": (NUMBERED, 2), "mark": (MARK, 1), "amendment": (AMENDMENT, 2), "notification": (NOTIFICATION, 0)}
    found = match_table(acts, id, text, kinds)
    placed = as_of_latest(found, id, F.col("kind") == "header", ["g1", "g2"]).withColumns(
        {"section_number": F.col("latest_g1"), "section_title": F.regexp_replace("latest_g2", r"^[ .-]+|[ .-]+$", "")}
    )
    number = F.regexp_replace("g1", r"^0+(?=\d)", "")
    bodies = placed.filter((F.col("kind") == "numbered") & (F.length(strip(F.col("g2"))) > LEAST)).groupBy(id, number.alias("number")).agg(F.max_by(strip(F.col("g2")), "at").alias("body"))
    marks = placed.filter("kind = 'mark'").withColumn("number", number).join(bodies, [id, "number"])
    amending = F.regexp_substr("body", F.lit(AMENDMENT))
    marks = marks.withColumn("line", amending).filter(F.col("line").isNotNull() | F.col("body").rlike(NOTIFICATION))

    def note(rows: DataFrame, source: int, line: Column, amends: Column, number: Column) -> DataFrame:
        prefix, by_act = F.regexp_extract(line, AMENDMENT, 1), F.regexp_extract(line, AMENDMENT, 2)
        return rows.select(
            id, "section_number", "section_title", number.try_cast("long").alias("footnote_id"), F.substring(strip(line), 1, MOST).alias("footnote_text"),
            F.when(amends, opening_type(prefix)).otherwise("note").alias("footnote_type"), F.when(amends, by_act).alias("by_act"),
            F.when(amends, F.nullif(F.regexp_extract(line, REPLACED, 1), F.lit(""))).alias("original_text"), F.when(amends, F.nullif(F.regexp_extract(line, EFFECTIVE, 1), F.lit(""))).alias("effective_date"),
            "at", F.lit(source).alias("_source"),
        )

    none = F.lit(None).cast("string")
    notes = note(marks, 1, F.coalesce("line", "body"), F.col("line").isNotNull(), F.col("number"))
    notes = notes.unionByName(note(placed.filter("kind = 'amendment'"), 2, F.col("whole"), F.lit(True), none))
    notes = notes.unionByName(note(placed.filter("kind = 'notification'"), 3, F.col("whole"), F.lit(False), none))
    first = W.partitionBy(id, "section_number", "footnote_text").orderBy("_source", "at")
    return notes.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n", "_source")


def structured_footnotes(text: Column) -> Column:
    """An array of structs (id, text, type, by_act, original_text) of the notes in a text's block of footnotes; empty without one."""

    def entries(block: Column) -> Column:
        numbers, bodies = F.regexp_extract_all(block, F.lit(ENTRY), F.lit(1)), F.regexp_extract_all(block, F.lit(ENTRY), F.lit(2))

        def entry(number: Column, body: Column) -> Column:
            def struct(note: Column) -> Column:
                act, original = F.regexp_substr(note, F.lit(r"Act\s+\d+\s+of\s+\d{4}")), F.regexp_extract(note, r"for\s+['\"](.+?)['\"]", 1)
                return F.struct(number.try_cast("long").alias("id"), note.alias("text"), content_type(note).alias("type"), act.alias("by_act"), F.nullif(original, F.lit("")).alias("original_text"))

            return _let(strip(F.regexp_replace(body, r"(?U)\s+", " ")), struct)

        return F.zip_with(numbers, bodies, entry)

    block = strip(F.regexp_extract(F.coalesce(text, F.lit("")), BLOCK, 1))
    return _let(block, entries)
