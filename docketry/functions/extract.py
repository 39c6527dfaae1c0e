"""Extraction columns: dates, parties, judges, citations, penalties, references, titles, headers."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from .redaction import _let
from .text import clean_field, collapse

# Date patterns of the sources, in the order in which they are tried.
DATE_FORMATS = ["d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy-M-d", "d-MMM-yyyy", "d MMM, yyyy", "d-M-yyyy H:m:s", "d/M/yyyy H:m"]
# Cities that follow the last comma of a party's name.
PARTY_CITIES = (
    "new delhi,delhi,mumbai,chennai,kolkata,bangalore,bengaluru,hyderabad,ahmedabad,pune,jaipur,lucknow,chandigarh,indore,cochin,kochi,surat,rajkot,"
    "nagpur,patna,guwahati,cuttack,raipur,jodhpur,dehradun,ranchi,agra,jabalpur,allahabad,varanasi,amritsar,visakhapatnam,panaji,goa,noida,gurgaon,"
    "gurugram,faridabad,thane,bhiwani,karnal,meerut,kanpur,bhopal,jamshedpur,ludhiana,coimbatore,ernakulam,trivandrum,thiruvananthapuram,madurai,"
    "vadodara,gandhinagar,bhubaneswar,shimla"
).split(",")
# Reporters and how they are cited.
REPORTERS = {
    "air": r"(?i)\bAIR\s+(\d{4})\s+([A-Z][a-z]*(?:&[A-Z])?|SC|FC)\s+(\d+)\b",
    "scc_parenthetical": r"(?i)\((\d{4})\)\s*(\d{1,2})\s*SCC\s+(\d+)",
    "scc_standard": r"(?i)\b(\d{4})\s+SCC\s+(\d{1,2})\s+(\d+)\b",
    "scc_online": r"(?i)\b(\d{4})\s+SCC\s+OnLine\s+SC\s+(\d+)\b",
    "scc_online_hc": r"(?i)\b(\d{4})\s+SCC\s+OnLine\s+([A-Z][a-z]{2,4})\s+(\d+)\b",
    "scr_standard": r"(?i)\bSCR\s*\((\d{1,2})\)\s*(\d{4})\s+(\d+)\b",
    "scr_bracket": r"(?i)\[(\d{4})\]\s*(\d{1,2})\s*SCR\s+(\d+)\b",
    "manu": r"(?i)\bMANU/([A-Z]{2,4})/(\d{4})/(\d+)\b",
    "neutral_sc": r"(?i)\b(\d{4})\s+INSC\s+(\d+)\b",
    "neutral_hc_colon": r"(?i)\b(\d{4}):([A-Z]{2,4}(?:-[A-Z]{2,4})?):(\d+)(?:-DB)?\b",
    "neutral_hc_slash": r"(?i)\b(\d{4})/([A-Z]{2,4})/(\d+)\b",
    "scale": r"(?i)\((\d{4})\)\s*(\d{1,2})\s*SCALE\s+(\d+)",
    "jt": r"(?i)\bJT\s+(\d{4})\s*\((\d{1,2})\)\s*SC\s+(\d+)\b",
    "bom_lr": r"(?i)\b(\d{4})\s*\((\d{1,2})\)\s*Bom\s*LR\s+(\d+)\b",
    "dlt": r"(?i)\b(\d{4})\s*\((\d{1,2})\)\s*DLT\s+(\d+)\b",
    "guj_lr": r"(?i)\b(\d{4})\s+Guj\s*LR\s+(\d+)\b",
    "klj": r"(?i)\b(\d{4})\s*\((\d{1,2})\)\s*KLJ\s+(\d+)\b",
    "klt": r"(?i)\b(\d{4})\s*\((\d{1,2})\)\s*KLT\s+(\d+)\b",
    "mlw": r"(?i)\b(\d{4})\s*\((\d{1,2})\)\s*MLW\s+(\d+)\b",
    "alj": r"(?i)\b(\d{4})\s+ALJ\s+(\d+)\b",
    "plr": r"(?i)\bPLR\s+(\d{4})\s+(\d+)\b",
    "cwn": r"(?i)\b(\d{4})\s*\((\d{1,2})\)\s*CWN\s+(\d+)\b",
    "itat": r"(?i)\b(\d{4})\s+ITAT\s+(\d+)\b|\bITA\s*No\.?\s*(\d+)/(\w+)/(\d{4})\b",
    "nclt": r"(?i)\b(?:NCLT|NCLAT)\s*(?:Order\s*)?(?:dated\s*)?(\d{1,2}[./]\d{1,2}[./]\d{2,4})?\s*(?:in\s*)?(?:CP|CA|TA)?\s*(?:No\.?)?\s*(\d+)",
    "ilr": r"(?i)\bILR\s+(\d{4})\s+([A-Za-z]+)\s+(\d{1,2})\s+(\d+)\b",
    "cri_lj": r"(?i)\b(\d{4})\s+Cri\s*LJ\s+(\d+)\b|\((\d{4})\)\s*(\d{1,2})\s*Cri\s*LJ\s+(\d+)",
    "comp_cas": r"(?i)\((\d{4})\)\s*(\d{1,3})\s*Comp\s*Cas\s+(\d+)",
    "itr": r"(?i)\((\d{4})\)\s*(\d{1,3})\s*ITR\s+(\d+)",
    "taxman": r"(?i)\((\d{4})\)\s*(\d{1,3})\s*Taxman\s+(\d+)",
    "gst": r"(?i)\b(\d{4})\s+GST\s+(\d+)\b",
}
#: Of each reporter, words of which a citation holds one, in upper case.
REPORTER_WORDS = {
    "air": ["AIR"], "scc_parenthetical": ["SCC"], "scc_standard": ["SCC"], "scc_online": ["ONLINE"], "scc_online_hc": ["ONLINE"], "scr_standard": ["SCR"], "scr_bracket": ["SCR"], "manu": ["MANU/"], "neutral_sc": ["INSC"],
    "neutral_hc_colon": [":"], "neutral_hc_slash": ["/"], "scale": ["SCALE"], "jt": ["JT"], "bom_lr": ["BOM"], "dlt": ["DLT"], "guj_lr": ["GUJ"], "klj": ["KLJ"], "klt": ["KLT"], "mlw": ["MLW"], "alj": ["ALJ"], "plr": ["PLR"],
    "cwn": ["CWN"], "itat": ["ITA"], "nclt": ["NCLT", "NCLAT"], "ilr": ["ILR"], "cri_lj": ["CRI"], "comp_cas": ["COMP"], "itr": ["ITR"], "taxman": ["TAXMAN"], "gst": ["GST"],
}
# How a citation's text tells its type, tried in this order.
CITATION_TYPES = [
    (r"SCC|S\.C\.C\.", "SCC"), (r"SCR|S\.C\.R\.", "SCR"), (r"AIR|A\.I\.R\.", "AIR"), ("INSC", "NEUTRAL"), ("MANU", "MANU"), ("SCALE", "SCALE"), ("JT", "JT"),
]
#: What parts the two sides of a title.
VERSUS = r"(?i)\s+(?:vs\.?|versus|v/s|v\.)\s+"
# Punishments in a provision.
IMPRISONMENT = (
    r"(?i)(?:imprison(?:ment|ed)\s+(?:of\s+)?(?:either\s+description\s+)?for\s+(?:a\s+term\s+)?)"
    r"(?:which\s+may\s+extend\s+to\s+|not\s+(?:be\s+)?less\s+than\s+)(\d+\s+(?:year|month|day|week)s?)"
)
FINE = r"(?i)(?:fine\s+(?:which\s+may\s+extend\s+to|not\s+(?:be\s+)?less\s+than|of)\s+)(?:rupees?\s+)?([\d,]+(?:\s+(?:lakh|crore|thousand)s?)?)"
PENALTY = r"(?i)(?:shall\s+be\s+(?:punish(?:ed|able)|liable\s+to))\s+with\s+([^.]{10,200})\."
SECTION_REFERENCE = r"(?:section|Section|Sec\.|sec\.)\s+(\d+[A-Z]?(?:\s*\([a-z0-9]+\))?)"
SCHEDULE_REFERENCE = r"(?i)(?:(?:First|Second|Third|Fourth|Fifth|Sixth|Seventh|Eighth|Ninth|Tenth)\s+Schedule|Schedule\s+[IVXLCDM]+)"
EFFECTIVE_DATES = [
    r"(?i)w\.e\.f\.\s+(\d{1,2}[./\-]\d{1,2}[./\-]\d{4})",
    r"(?i)w\.e\.f\.\s+(\d{1,2}(?:st|nd|rd|th)?\s+\w+,?\s+\d{4})",
    r"(?i)with\s+effect\s+from\s+(?:the\s+)?(\d{1,2}(?:st|nd|rd|th)?\s+\w+,?\s+\d{4})",
]


def nonempty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_nonempty(*columns: Column) -> Column:
    """The first of the columns that is neither null nor empty."""
    return F.coalesce(*(nonempty(c) for c in columns))


def _plain_date(raw: Column) -> Column:
    """A date in one of the formats; two-digit years from 69 on are of the last century."""
    tries = [F.when(raw.rlike(r"^\d{4}-" if f.startswith("yyyy") else r"^\d{1,2}[/\-. ]"), F.try_to_timestamp(raw, F.lit(f))) for f in DATE_FORMATS]
    short = F.regexp_extract(raw, r"^(\d{1,2}[-/]\d{1,2}[-/])(\d{2})$", 2)
    century = F.when(short >= "69", "19").otherwise("20")
    full = F.when(short != "", F.concat(F.regexp_extract(raw, r"^(\d{1,2}[-/]\d{1,2}[-/])(\d{2})$", 1), century, short))
    tries += [F.try_to_timestamp(full, F.lit(f)) for f in ("d-M-yyyy", "d/M/yyyy")]
    return F.date_format(F.coalesce(*tries), "yyyy-MM-dd")


def parse_date(raw: Column) -> Column:
    """ISO date of a scraped date: ISO prefix, spreadsheet serial, a date after "dated", or one of the formats; else null."""
    raw = nonempty(F.trim(raw))
    serial = F.when(raw.rlike(r"^\d{5}$"), raw.try_cast("int"))
    dated = F.regexp_extract(raw, r"[Dd](?:ate)?[dt]\.?\s*(\d{1,2}[.\-/]\d{1,2}[.\-/]\d{2,4})", 1)
    return (
        F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(raw, 1, 10))
        .when(serial.between(30000, 50000), F.date_format(F.date_add(F.lit("1899-12-30").cast("date"), serial), "yyyy-MM-dd"))
        .when(dated != "", _plain_date(dated))
        .otherwise(_plain_date(raw))
    )


def year_of(date: Column, *fallbacks: Column) -> Column:
    """Year of an ISO date, else the first four characters of a fallback if they are a year from 1900 to 2100."""
    years = [F.when(y.between(1900, 2100), y) for y in (F.substring(f.cast("string"), 1, 4).try_cast("int") for f in fallbacks)]
    return F.coalesce(F.substring(date, 1, 4).try_cast("int"), *years)


def assessment_year(raw: Column) -> Column:
    """2018-2019 and 2018-19 as 2018-19, all else as null."""
    raw = F.trim(raw)
    return F.when(raw.rlike(r"^\d{4}-\d{4}$"), F.concat(F.substring(raw, 1, 5), F.substring(raw, 8, 2))).when(raw.rlike(r"^\d{4}-\d{2}$"), raw)


def day_first_to_iso(raw: Column) -> Column:
    """DD-MM-YYYY at the start as ISO; anything else as it is."""
    return F.when(raw.rlike(r"^\d{2}-\d{2}-\d{4}"), F.concat_ws("-", F.substring(raw, 7, 4), F.substring(raw, 4, 2), F.substring(raw, 1, 2))).otherwise(raw)


def party_and_city(name: Column) -> Column:
    """A struct of a party and the known city after its last comma; the city is empty if there is none."""
    city = F.trim(F.substring_index(name, ",", -1))
    known = name.contains(",") & F.lower(city).isin(PARTY_CITIES)
    party = F.trim(F.substring(name, F.lit(1), F.length(name) - F.length(F.substring_index(name, ",", -1)) - 1))
    return F.struct(F.when(known, party).otherwise(name).alias("party"), F.when(known, F.initcap(city)).otherwise("").alias("city"))


def parties(title: Column) -> Column:
    """A struct of the two sides of a title; the second is empty if there is none."""
    sides = F.split(title, VERSUS, 2)
    return F.struct(clean_field(F.get(sides, F.lit(0))).alias("petitioner"), clean_field(F.get(sides, F.lit(1))).alias("respondent"))


def judges(raw: Column) -> Column:
    """Judges of a field, split at the first of comma, and, ampersand, semicolon that it has."""
    text = clean_field(raw)
    parts = F.array(text)
    for separator in (";", "&", " and ", ","):
        parts = F.when(text.contains(separator), F.split(text, separator)).otherwise(parts)
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def case_title(number: Column, petitioner: Column, respondent: Column, year: Column) -> Column:
    """``petitioner Vs respondent [number] (year)``, names cut at 80 characters; Unknown if there is nothing."""

    def cut(x: Column) -> Column:
        return F.when(F.length(x) > 80, F.concat(F.substring(x, 1, 80), F.lit("..."))).otherwise(x)

    parts = F.concat_ws(
        " ", cut(nonempty(petitioner)), F.concat(F.lit("Vs "), cut(nonempty(respondent))), F.concat(F.lit("["), nonempty(number), F.lit("]")), F.concat(F.lit("("), F.when(year != 0, year).cast("string"), F.lit(")"))
    )
    return F.when(parts == "", "Unknown").otherwise(parts)


def case_header(title: Column, citation: Column, year: Column, section: Column, court: Column | None = None) -> Column:
    """The header of a chunk: case, citation and year, court where given, and section."""
    short = F.when(F.length(title) > 100, F.concat(F.substring(title, 1, 100), F.lit("..."))).otherwise(F.coalesce(title, F.lit("Untitled")))
    head = F.concat_ws(" ", F.concat(F.lit("Case: "), short), F.concat(F.lit("["), nonempty(citation), F.lit("]")), F.concat(F.lit("("), F.when(year > 0, year).cast("string"), F.lit(")")))
    if court is not None:
        head = F.concat_ws("\n", head, F.concat(F.lit("Court: "), nonempty(court)))
    return F.concat(head, F.lit("\nSection: "), F.upper(section), F.lit("\n\n"))


def citations(text: Column) -> Column:
    """All citations of a text as an array of structs of reporter and raw text; a reporter is searched for where its name is in the text."""
    none = F.array().cast("array<struct<reporter:string,raw:string>>")

    def all_of(text: Column, upper: Column) -> Column:
        def of(reporter: str, pattern: str) -> Column:
            found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda x: F.struct(F.lit(reporter).alias("reporter"), x.alias("raw")))
            named = F.lit(False)
            for word in REPORTER_WORDS[reporter]:
                named = named | F.contains(upper, F.lit(word))
            return F.when(named, found).otherwise(none)

        return F.flatten(F.array(*(of(reporter, pattern) for reporter, pattern in REPORTERS.items())))

    return _let(F.struct(text.alias("t"), F.upper(text).alias("u")), lambda s: F.when(s["t"].isNotNull(), all_of(s["t"], s["u"])))


def _undotted(citation: Column) -> Column:
    """S.C.R. as SCR: dots between and after single capitals go."""
    inner = F.regexp_replace(citation, r"(?<![A-Z])([A-Z])\.(?=[A-Z](?:\.|[^A-Z]|$))", "$1")
    for _ in range(5):
        inner = F.regexp_replace(inner, r"(?<=[A-Z])([A-Z])\.(?=[A-Z](?:\.|[^A-Z]|$))", "$1")
    return F.regexp_replace(inner, r"(?<=[A-Z]{2})\.(?=\s|$|[^A-Z])", "")


def alias_key(citation: Column) -> Column:
    """A citation as aliases are matched: upper case, no dots within abbreviations, no brackets, single spaces."""
    out = F.regexp_replace(_undotted(F.upper(F.trim(citation))), r"[\[\]()]", "")
    return F.regexp_replace(F.regexp_replace(out, r"[-_/]+", " "), r"\s+", " ")


def graph_key(citation: Column) -> Column:
    """A citation as the graph matches it: like an alias, but brackets and slashes stay."""
    out = F.regexp_replace(_undotted(F.upper(citation)), r"[-_]+", " ")
    for pattern, replacement in ((r"\(\s+", "("), (r"\s+\)", ")"), (r"\[\s+", "["), (r"\s+\]", "]")):
        out = F.regexp_replace(out, pattern, replacement)
    return collapse(out)


def citation_type(citation: Column) -> Column:
    out = F.lit("OTHER")
    for pattern, kind in reversed(CITATION_TYPES):
        out = F.when(F.upper(citation).rlike(pattern), kind).otherwise(out)
    return out


def _distinct_matches(text: Column, pattern: str, group: int = 1) -> Column:
    """In the order in which they are first found."""
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(text, F.lit(pattern), group), lambda x: F.trim(x)), lambda x: x != ""))


def penalties(text: Column) -> Column:
    """A struct of imprisonment terms, fines and the first penalty's text; null if there is no penalty."""
    terms, fines, texts = _distinct_matches(text, IMPRISONMENT), _distinct_matches(text, FINE), F.regexp_extract_all(text, F.lit(PENALTY), 1)
    found = F.struct(F.lit(True).alias("has_penalty"), terms.alias("imprisonment"), fines.alias("fine"), F.coalesce(F.trim(F.get(texts, F.lit(0))), F.lit("")).alias("penalty_text"))
    return F.when((F.size(terms) > 0) | (F.size(fines) > 0) | (F.size(texts) > 0), found)


def internal_references(text: Column, own: Column) -> Column:
    """Other sections and the schedules that a section refers to."""
    sections = F.filter(_distinct_matches(text, SECTION_REFERENCE), lambda x: ~x.eqNullSafe(own))
    return F.array_distinct(F.concat(sections, _distinct_matches(text, SCHEDULE_REFERENCE, 0)))


def effective_dates(text: Column) -> Column:
    return F.array_distinct(F.concat(*(_distinct_matches(text, p) for p in EFFECTIVE_DATES)))


def sorted_json(fields: dict[str, Column], numbers: Collection[str] = ()) -> Column:
    """A JSON object as text: keys in order, a space after colons and commas, characters beyond ASCII escaped, nulls written; ``numbers`` names keys of whole numbers."""

    def quoted(value: Column) -> Column:
        plain = F.to_json(F.array(value.cast("string")))
        inner = F.substring(plain, F.lit(2), F.length(plain) - 2)
        codes = F.transform(F.filter(F.split(F.coalesce(inner, F.lit("")), ""), lambda c: c != ""), _ascii)
        return F.when(value.isNull(), "null").otherwise(F.when(inner.rlike(r"[^\x00-\x7f]"), F.array_join(codes, "")).otherwise(inner))

    parts = [F.concat(F.lit(f'"{k}": '), F.coalesce(v.cast("string"), F.lit("null")) if k in numbers else quoted(v)) for k, v in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def _ascii(c: Column) -> Column:
    """A character as JSON writes it in ASCII: UTF-16 units of four hexadecimal digits beyond it."""
    units = F.lower(F.hex(F.encode(c, "UTF-16BE")))
    escaped = F.concat(F.lit("\\u"), F.substring(units, 1, 4), F.when(F.length(units) > 4, F.concat(F.lit("\\u"), F.substring(units, 5, 4))).otherwise(""))
    return F.when(c.rlike(r"^[\x00-\x7f]$"), c).otherwise(escaped)


def case_id(slug: str, number: Column, fallback: dict[str, Column], with_context: bool = False, numbers: Collection[str] = ()) -> Column:
    """``SLUG_NUMBER`` of letters and digits, or else twelve digits of a hash of the fallback's JSON.

    ``with_context`` adds eight digits of that hash to the number too, where numbers recur from bench to bench and year to year.
    """
    plain = F.regexp_replace(F.upper(nonempty(number)), r"[^A-Za-z0-9]", "")
    digest = F.md5(sorted_json(fallback, numbers))
    if with_context:
        plain = F.concat(plain, F.lit("_"), F.substring(digest, 1, 8))
    return F.concat(F.lit(f"{slug.upper()}_"), F.coalesce(plain, F.substring(digest, 1, 12)))
