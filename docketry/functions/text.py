"""Text-cleaning columns: tags, whitespace, slugs, page furniture, boxes."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that extraction leaves behind, and what they stand for.
REPLACEMENTS = {
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-",
    " ": " ", "​": "", "‌": "", "‍": "", "﻿": "",
}
#: Words that don't belong in a bench's slug.
BENCH_NOISE = ["bench", "tribunal", "principal", "hon'ble", "court -"]
#: Boxes that are page furniture, and marks of those that are titles.
SKIPPED_BOXES = ["page-header", "page-footer"]
BOX_MARKS = {"title": "[TITLE] # ", "section-header": "[SECTION] ## "}


#: What counts as white space at the ends of a text, in Unicode's terms.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """A text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def collapse(text: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+", " "))


def clean_field(text: Column) -> Column:
    """A scraped field without markup, dangling attributes and party suffixes; null becomes empty."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?i)^(?:color|font|size|style)=['\"]?[^'\"]*['\"]?>(.*)", "$1")
    out = F.regexp_replace(out, r"<[^>]+>", "")
    return collapse(F.regexp_replace(out, r"\s*Additional Party\([^)]*\):?\s*$", ""))


def clean_ocr(text: Column) -> Column:
    """Recognition artefacts (tags, asterisks, hashes, pipes, backticks) as spaces, collapsed."""
    return collapse(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]+>", " "), r"[*#|`]+", " "))


def slug(title: Column, separator: str = "-") -> Column:
    """Lower-case letters and digits, everything else as one separator."""
    return F.trim(F.regexp_replace(F.lower(title), r"[^a-z0-9]+", separator), F.lit(separator))


def bench_slug(prefix: str, bench: Column) -> Column:
    """``prefix_bench`` of at most 30 characters of bench; just the prefix where nothing is left."""
    name = F.lower(F.trim(bench))
    for noise in BENCH_NOISE:
        name = F.replace(name, F.lit(noise), F.lit(""))
    name = F.trim(F.regexp_replace(F.trim(name), r"[^a-z0-9]+", "_"), F.lit("_"))
    name = F.rtrim(F.substring(name, 1, 30), F.lit("_"))
    return F.when(F.coalesce(name, F.lit("")) == "", prefix).otherwise(F.concat(F.lit(f"{prefix}_"), name))


@F.pandas_udf(T.StringType())
def unescape(text: pd.Series) -> pd.Series:
    """HTML entities as characters; Spark has no built-in for it."""
    return text.map(lambda x: None if x is None else html.unescape(x))


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode normal form C; Spark has no built-in for it."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def html_to_text(markup: Column) -> Column:
    """Text of an act's HTML: line breaks and rules as newlines, footnote marks in brackets, no tags, at most two newlines."""
    steps = [
        (r"(?i)<br\s*/?>", "\n"),
        (r"(?i)<hr\s*/?>", "\n\n"),
        (r"(?is)<sup[^>]*>\s*(\d+)\s*</sup>", "[$1]"),
        (r"(?i)<span\s+style=\"margin-left:\d+px;\">\s*</span>", ""),  # indentation alone; what else stands in spans stays
        (r"<[^>]+>", ""),
    ]
    for pattern, replacement in steps:
        markup = F.regexp_replace(markup, pattern, replacement)
    text = unescape(markup)
    for pattern, replacement in [(r"\r\n?", "\n"), (r"(?m)[ \t]+$", ""), (r"\n{3,}", "\n\n")]:
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(text)


def footnote_to_text(markup: Column) -> Column:
    """Text of a footnote's HTML: line breaks and rules as newlines, no tags, no blanks at line ends; empty for null."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(markup, F.lit("")), r"(?i)<[bh]r\s*/?>", "\n"), r"<[^>]+>", "")
    return strip(F.regexp_replace(F.regexp_replace(unescape(text), r"\r\n?", "\n"), r"(?m)[ \t]+$", ""))


def section_to_text(number: Column, label: Column, content: Column, footnote: Column) -> Column:
    """Text of an act's section in HTML: its number and label, its content, and its footnotes under a mark of their own; empty if there is nothing."""
    n, name = F.trim(F.coalesce(number, F.lit(""))), F.trim(F.coalesce(label, F.lit("")))
    header = F.when((n != "") & (name != ""), F.concat(n, F.lit(". "), name)).when(n != "", F.concat(n, F.lit("."))).otherwise(name)
    notes = footnote_to_text(footnote)
    parts = [F.nullif(x, F.lit("")) for x in (header, strip(html_to_text(F.coalesce(content, F.lit("")))))]
    return F.concat_ws("\n", *parts, F.concat(F.lit("\n[Footnotes]\n"), F.nullif(notes, F.lit(""))))


def normalize_characters(text: Column) -> Column:
    """Normal form C, typographic characters replaced, control characters dropped."""
    out = nfc(text)
    for old, new in REPLACEMENTS.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(out, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def text_of_boxes(boxes: Column) -> Column:
    """Text of layout boxes (box_class, text) without furniture, titles and headings marked."""
    mark = F.lit("")
    kept = F.filter(boxes, lambda b: ~b["box_class"].isin(SKIPPED_BOXES) & (F.trim(b["text"]) != ""))

    def marked(b: Column) -> Column:
        out = mark
        for kind, m in BOX_MARKS.items():
            out = F.when(b["box_class"] == kind, m).otherwise(out)
        return F.concat(out, F.trim(b["text"]))

    return F.array_join(F.transform(kept, marked), "\n\n")


def repeated_edges(pages: DataFrame, share: float = 0.4, least_pages: int = 3) -> DataFrame:
    """Header and footer lines of documents: (doc_id, line) of ``pages`` (doc_id, page_number, text).

    A line counts if it is among the first or last two lines that aren't empty
    on at least ``share`` of a document's pages, and has more than three characters.
    """
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    edges = F.array_distinct(F.concat(F.slice(lines, 1, 2), F.when(F.size(lines) > 2, F.slice(lines, -2, 2)).otherwise(F.array())))
    seen = pages.select("doc_id", F.explode(edges).alias("line")).groupBy("doc_id", "line").count()
    number = pages.groupBy("doc_id").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages)
    enough = F.col("count") >= F.greatest(F.floor(F.col("pages") * share), F.lit(1))
    return seen.join(number, "doc_id").filter(enough & (F.length("line") > 3)).select("doc_id", "line")
