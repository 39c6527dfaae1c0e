"""Columns on acts and their sections: amendments, acts referred to, defined terms, extent, commencement, what is enacted and repealed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.footnotes import structured_footnotes
from . import classify, extract
from .redaction import _let
from .text import strip

# Notes of amendments in brackets, and on lines of their own.
_CHANGED = r"(?:Ins|Subs|Added|Omitted|Rep)\.\s+by\s+Act\s+\d+\s+of\s+\d{4}"
BRACKETED = rf"(?i)\[{_CHANGED}(?:,\s*(?:s|w\.e\.f)\.\s*[^]]+)?\]"
LINED = rf"(?i)(?:^|\n)\s*\d*\.?\s*({_CHANGED}(?:,\s*s\.\s*\d+[^.]*)?)"
# Names of acts, terms that are defined, where and from when an act holds.
ACT_NAME = r"(?:the\s+)?((?:[A-Z][a-z]+\s+){1,6}(?:Act|Code|Ordinance),?\s+\d{4})"
DEFINED, LONGEST_TERM = r"(?i)[\"“]([^\"”]{2,60})[\"”]\s+means\b", 50
EXTENT = r"(?i)(?:extends?\s+to\s+)(the\s+whole\s+of\s+India|the\s+State\s+of\s+\w+(?:\s+\w+)*|the\s+Union\s+[Tt]erritor(?:y|ies)\s+of\s+\w+(?:\s+\w+)*)"
COMMENCEMENT = [
    r"(?i)shall\s+come\s+into\s+force\s+on\s+([^.;]+)",
    r"(?i)shall\s+be\s+deemed\s+to\s+have\s+come\s+into\s+force\s+on\s+([^.;]+)",
    r"(?i)come\s+into\s+force\s+(?:on\s+)?(?:the\s+)?(\d{1,2}(?:st|nd|rd|th)?\s+\w+,?\s+\d{4})",
]
# Dates of assent, ministries, formulas, numbers, gazettes; and the parts of a text that they are looked for in.
ASSENTS = [
    r"(?i)\[\s*(?:Passed\s+on\s+(?:the\s+)?)?(\d{1,2}(?:st|nd|rd|th)?\s+\w+,?\s+\d{4})\s*\]",
    r"(?i)(?:received\s+the\s+assent\s+of\s+the\s+President\s+on\s+(?:the\s+)?)(\d{1,2}(?:st|nd|rd|th)?\s+\w+,?\s+\d{4})",
    r"(?i)(?:Date\s+of\s+Assent[:\s]+)(\d{1,2}[./\-]\d{1,2}[./\-]\d{4})",
]
MINISTRIES = [r"(?:Ministry\s+of\s+)([\w\s,&]+?)(?:\.|,|\n|$)", r"(?:Department\s+of\s+)([\w\s,&]+?)(?:\.|,|\n|$)", r"(?:MINISTRY\s+OF\s+)([\w\s,&]+?)(?:\.|,|\n|$)"]
ENACTED, LONG_TITLE = r"(?i)(Be\s+it\s+enacted\s+by\s+[^.]+\.)", r"(?i)(An\s+Act\s+to\s+[^.]+\.)"
NUMBER, GAZETTE = r"(?:Act\s+No\.?\s*|ACT\s+NO\.?\s*)(\d+|[IVXLCDM]+)\s+(?:of|OF)\s+(\d{4})", r"(?i)(?:Gazette\s+of\s+India|Official\s+Gazette)[^.]*\."
REPEALS = [
    r"(?i)(?:hereby\s+)?repeal(?:s|ed)\s+(?:the\s+)?((?:[A-Z][\w\s,.']+?)(?:Act|Regulation|Code|Ordinance),?\s+\d{4})",
    r"(?i)Repeal\s+(?:of\s+)?([\w\s,.]+?(?:Act|Regulation),?\s+\d{4})",
    r"(?i)(?:Repeal\s+)([\w\s,.]+?\d{4})",
]
HEAD, EXTENT_WITHIN, REPEALS_WITHIN = 3000, 5000, 10_000
# Decisions cited in acts, and periods of limitation.
DECISIONS = r"(?:\(\d{4}\)\s+\d+\s+SCC\s+\d+|AIR\s+\d{4}\s+SC\s+\d+|\d{4}\s+SCC\s+\(Cri\)\s+\d+|\(\d{4}\)\s+\d+\s+SCC\s+\([A-Za-z]+\)\s+\d+|ILR\s+\d{4}\s+\w+\s+\d+)"
LIMITATION = r"(?i)within\s+(?:a\s+period\s+of\s+)?(\d+\s+(?:day|month|year|week)s?)"


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    """All that a pattern's group finds, without white space at its ends."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(group)), strip)


def _one(text: Column, pattern: str, group: int = 1) -> Column:
    """The first that a pattern's group finds; null without one."""
    return F.nullif(strip(F.regexp_extract(text, pattern, group)), F.lit(""))


def _without_comma(text: Column) -> Column:
    return strip(F.regexp_replace(text, ",+$", ""))


def _different(items: Column, least: int = 1) -> Column:
    return F.array_distinct(F.filter(items, lambda x: F.length(x) >= least))


def amendments(text: Column) -> Column:
    """Different notes of amendments: those in brackets first, then those on lines of their own."""
    bracketed = F.transform(_all(text, BRACKETED, 0), lambda x: strip(F.btrim(x, F.lit("[]"))))
    return _different(F.concat(bracketed, _all(text, LINED)))


def acts_referenced(text: Column) -> Column:
    """Different names of acts with their years, in order."""
    return _different(F.transform(_all(text, ACT_NAME), lambda x: strip(F.btrim(x, F.lit(",")))))


def defined_terms(text: Column) -> Column:
    """Different defined terms in lower case, sorted; long ones are none."""
    return F.array_sort(_different(F.filter(F.transform(_all(text, DEFINED), F.lower), lambda x: F.length(x) <= LONGEST_TERM)))


def extent(text: Column) -> Column:
    return _one(text, EXTENT)


def commencement(text: Column) -> Column:
    return F.coalesce(*(_without_comma(_one(text, p)) for p in COMMENCEMENT))


def enacting(header: Column) -> Column:
    """A struct (date_of_assent, ministry, enacting_formula, long_title) of an act's head."""
    ministries = [_without_comma(_one(header, p)) for p in MINISTRIES]
    ministry = F.coalesce(*(F.when(F.length(m).between(4, 79), m) for m in ministries))
    return F.struct(F.coalesce(*(_one(header, p) for p in ASSENTS)).alias("date_of_assent"), ministry.alias("ministry"), _one(header, ENACTED).alias("enacting_formula"), _one(header, LONG_TITLE).alias("long_title"))


def repeals(text: Column) -> Column:
    """Different acts that a text repeals, by one pattern after the other; names of five characters and fewer are none."""
    return _different(F.concat(*(F.transform(_all(text, p), _without_comma) for p in REPEALS)), 6)


def limitation_periods(text: Column) -> Column:
    return _different(_all(text, LIMITATION))


def decisions_cited(text: Column) -> Column:
    return _different(_all(text, DECISIONS, 0))


def act_metadata(text: Column) -> Column:
    """A struct of what an act's whole text and its head say of it; null members and empty lists where they say nothing."""

    def of(t: Column) -> Column:
        header = F.substring(t, 1, HEAD)
        return F.struct(
            extent(F.substring(t, 1, EXTENT_WITHIN)).alias("territorial_extent"), commencement(F.substring(t, 1, EXTENT_WITHIN)).alias("commencement"), _one(header, NUMBER).alias("act_number"), _one(header, NUMBER, 2).cast("int").alias("act_year"),
            _one(header, GAZETTE, 0).alias("gazette"), enacting(header).alias("enacting"), repeals(F.substring(t, 1, REPEALS_WITHIN)).alias("repeals"), acts_referenced(t).alias("acts_referenced"), amendments(t).alias("amendment_notes"),
        )

    return _let(F.coalesce(text, F.lit("")), of)


def section_metadata(text: Column, kind: Column, number: Column) -> Column:
    """A struct of all that one section says of itself; terms are looked for in definitions alone."""
    none = F.array().cast("array<string>")

    def of(t: Column) -> Column:
        notes = amendments(t)
        return F.struct(
            notes.alias("amendment_notes"), F.size(notes).alias("amendment_count"), acts_referenced(t).alias("acts_referenced"), F.when(kind == "definitions", defined_terms(t)).otherwise(none).alias("defined_terms"),
            extract.penalties(t).alias("penalty"), extract.effective_dates(t).alias("effective_dates"), classify.provision_type(t).alias("provision_type"), F.struct(*(v.alias(k) for k, v in classify.legal_markers(t).items())).alias("markers"), classify.section_status(t).alias("section_status"),
            extract.internal_references(t, number).alias("sections_referenced"), classify.delegation_type(t, number).alias("delegation_type"), structured_footnotes(t).alias("footnotes"), decisions_cited(t).alias("case_citations"), limitation_periods(t).alias("limitation_periods"),
        )

    return _let(F.coalesce(text, F.lit("")), of)


def _titled(text: Column) -> Column:
    """Each run of letters with its first one as a capital and small ones behind it."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, F.lit(2), F.length(r))))), "")


def provision_header(title: Column, year: Column, category: Column, act_number: Column, status: Column, chapter: Column, chapter_title: Column, number: Column, section_title: Column, sub_section: Column) -> Column:
    """A line on the act (title, number or year, India, category, status) and one on the place in it, if that is known, parted by bars."""
    said, when = extract.nonempty, F.when(year > 0, year).cast("string")
    reference = F.coalesce(F.concat(F.lit(" (Act "), said(act_number), F.lit(" of "), when, F.lit(")")), F.concat(F.lit(" ("), when, F.lit(")")), F.lit(""))
    act = F.concat_ws(" | ", F.concat(F.lit("Act: "), F.coalesce(title, F.lit("")), reference), F.lit("India"), _titled(said(category)), _titled(F.replace(said(status), F.lit("_"), F.lit(" "))))
    section = said(F.concat(F.coalesce(F.concat(F.lit("Section "), said(number)), F.lit("")), F.coalesce(sub_section, F.lit(""))))
    place = F.concat_ws(" | ", F.concat(F.lit("Chapter "), said(chapter), F.coalesce(F.concat(F.lit(": "), said(chapter_title)), F.lit(""))), F.concat(section, F.coalesce(F.concat(F.lit(": "), said(section_title)), F.lit(""))))
    return F.concat_ws("\n", act, said(place))
