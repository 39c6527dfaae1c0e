"""Columns on judgments: header metadata, what they cite, how they end, names of judges and courts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .classify import first_match, matches
from .redaction import _let
from .text import clean_ocr, collapse

#: Characters of the head, and of the end, in which metadata are looked for.
HEAD, END = 5000, 4000
# Dates of decisions, tried in this order; the letters say what the groups are (D day, M month, W its name, Y year).
DATES = [
    (r"(?i)DATE\s*:\s*(\d{1,2})(?:ST|ND|RD|TH)?\s+(\w+)\s+(\d{4})", "DWY"),
    (r"(?i)DATED\s*:\s*(\d{1,2})[./](\d{1,2})[./](\d{2,4})", "DMY"),
    (r"(?i)DATED?\s*:?-?\s*(\w+)\s+(\d{1,2}),?\s+(\d{4})", "WDY"),
    (r"(?i)(?:Judgment|Order)\s+Date\s*:\s*(\d{1,2})[./](\d{1,2})[./](\d{2,4})", "DMY"),
    (r"(?i)Date\s+of\s+(?:Judgment|Order)\s*:\s*(\w+)\s+(\d{1,2}),?\s+(\d{4})", "WDY"),
    (r"(?i)(?:on|dated?)\s+(\d{1,2})(?:ST|ND|RD|TH)?\s+(\w+),?\s+(\d{4})", "DWY"),
    (r"(?:^|\s)(\d{1,2})[./](\d{1,2})[./](\d{4})(?:\s|$)", "DMY"),
]
MONTHS = "january february march april may june july august september october november december".split()
# Case types, tried in this order.
CASE_TYPES = [
    (r"(?i)WRIT\s+PETITION", "WRIT PETITION"),
    (r"(?i)CRIMINAL\s+APPEAL", "CRIMINAL APPEAL"),
    (r"(?i)CIVIL\s+APPEAL", "CIVIL APPEAL"),
    (r"(?i)SPECIAL\s+LEAVE\s+PETITION", "SPECIAL LEAVE PETITION"),
    (r"(?i)BAIL\s+APPLICATION", "BAIL APPLICATION"),
    (r"(?i)ANTICIPATORY\s+BAIL", "ANTICIPATORY BAIL"),
    (r"(?i)CONTEMPT\s+(?:PETITION|CASE)", "CONTEMPT"),
    (r"(?i)REVIEW\s+(?:PETITION|APPLICATION)", "REVIEW PETITION"),
    (r"(?i)FIRST\s+APPEAL", "FIRST APPEAL"),
    (r"(?i)SECOND\s+APPEAL", "SECOND APPEAL"),
    (r"(?i)MISC\.?\s*(?:CIVIL|CRIMINAL)?\s*APPLICATION", "MISCELLANEOUS APPLICATION"),
    (r"(?i)APPEAL\s+FROM\s+ORDER", "APPEAL FROM ORDER"),
    (r"(?i)ORIGINAL\s+(?:SIDE\s+)?(?:SUIT|PETITION)", "ORIGINAL PETITION"),
    (r"(?i)LETTERS?\s+PATENT\s+APPEAL", "LETTERS PATENT APPEAL"),
    (r"(?i)(?:CRL|CRIMINAL)\s*\.?\s*(?:MC|MISC)", "CRIMINAL MISCELLANEOUS"),
    (r"(?i)(?:CIVIL|CIV)\s*\.?\s*(?:MC|MISC)", "CIVIL MISCELLANEOUS"),
    (r"(?i)PUBLIC\s+INTEREST\s+LITIGATION|\bPIL\b", "PIL"),
    (r"(?i)\bW\.?\s*P\.?\s*\(?\s*(?:C|Crl|CIVIL|CRIMINAL)\s*\)?", "WRIT PETITION"),
    (r"(?i)\bCr\.?\s*A\.?", "CRIMINAL APPEAL"),
    (r"(?i)\bC\.?\s*A\.?", "CIVIL APPEAL"),
    (r"(?i)\bSLP", "SPECIAL LEAVE PETITION"),
    (r"(?i)\bCRL\.?\s*M\.?\s*C\.?", "CRIMINAL MISCELLANEOUS"),
    (r"(?i)\bC\.?\s*M\.?\s*A\.?", "CIVIL MISCELLANEOUS APPLICATION"),
]
# Case numbers, tried in this order, with the number of groups that make one.
CASE_NUMBERS = [
    (r"(?i)(?:Case\s*No\.?|W\.?P\.?\s*(?:\(C\))?|Cr\.?\s*A\.?|C\.?\s*A\.?|SLP|CRL\.?\s*M\.?\s*C\.?)\s*(?:No\.?\s*)?(\d+(?:/\d+)?(?:\s*of\s*\d{4})?)", 1),
    (r"(?i)(?:Writ\s+Petition|Criminal\s+Appeal|Civil\s+Appeal)\s*(?:\([^)]+\))?\s*(?:No\.?\s*)?(\d+(?:/\d+)?)\s*(?:of\s*)?(\d{4})", 2),
    (r"(?i)(?:No\.?|Number)\s*:?\s*(\d+(?:/\d+)?)\s*(?:of|/)\s*(\d{4})", 2),
]
# Jurisdictions, tried in this order; then by the case's type.
JURISDICTIONS = [
    (r"(?i)CRIMINAL\s+(?:APPELLATE\s+)?JURISDICTION", "CRIMINAL"),
    (r"(?i)CIVIL\s+(?:APPELLATE\s+)?JURISDICTION", "CIVIL"),
    (r"(?i)WRIT\s+JURISDICTION", "WRIT"),
    (r"(?i)ORIGINAL\s+(?:CIVIL\s+)?JURISDICTION", "ORIGINAL"),
    (r"(?i)APPELLATE\s+JURISDICTION", "APPELLATE"),
    (r"(?i)REVISIONAL\s+JURISDICTION", "REVISIONAL"),
    (r"(?i)CRIMINAL\s+APPEAL", "CRIMINAL"),
    (r"(?i)CIVIL\s+APPEAL", "CIVIL"),
    (r"(?i)WRIT\s+PETITION", "WRIT"),
    (r"(?i)BAIL\s+APPLICATION|ANTICIPATORY\s+BAIL", "CRIMINAL"),
]
JURISDICTION_OF_TYPE = [("CRIMINAL|BAIL", "CRIMINAL"), ("CIVIL", "CIVIL"), ("WRIT|PIL", "WRIT")]
# Outcomes, tried in this order.
OUTCOMES = [
    (r"(?i)\ballowed\b", "ALLOWED"),
    (r"(?i)\bdismissed\b", "DISMISSED"),
    (r"(?i)\brejected\b", "REJECTED"),
    (r"(?i)\bdisposed\s+(?:of|off)\b", "DISPOSED"),
    (r"(?i)\bwithdrawn\b", "WITHDRAWN"),
    (r"(?i)\bquashed\b", "QUASHED"),
    (r"(?i)\bremanded\b", "REMANDED"),
    (r"(?i)\bstayed\b", "STAYED"),
    (r"(?i)\bsine\s+die\b", "ADJOURNED SINE DIE"),
    (r"(?i)\bacquitted\b", "ACQUITTED"),
    (r"(?i)\bconvicted\b", "CONVICTED"),
]
# Benches, tried in this order.
BENCHES = [
    (r"(?i:Division\s+Bench)|\bDB\b", "DIVISION BENCH"),
    (r"(?i:Full\s+Bench)|\bFB\b", "FULL BENCH"),
    (r"(?i:Single\s+(?:Judge\s+)?Bench)|\bSB\b", "SINGLE BENCH"),
    (r"(?i)Constitution\s+Bench", "CONSTITUTION BENCH"),
    (r"(?i)Larger\s+Bench", "LARGER BENCH"),
]
# Sections of acts, and articles of the constitution.
_PROVISION = r"(\d+(?:\s*\([a-zA-Z0-9]+\))?(?:\s*(?:r/w|read\s+with)\s*\d+(?:\s*\([a-zA-Z0-9]+\))?)*)\s+(?:of\s+)?(?:the\s+)?"
ACT = r"(?i)(?:Section|Sec\.?|S\.?)\s*" + _PROVISION + r"([A-Z][A-Za-z\s,\.]+?(?:Act|Code|Rules|Regulations|Order)(?:\s*,?\s*\d{4})?)"
ARTICLE = r"(?i)Article\s+" + _PROVISION + "Constitution"
# What a judge's name isn't.
JUNK_NAMES = [
    "advocate", "therefore", "however", "namely", "thereafter", "vide", "punjab", "judge", "this day", "if any", "as such", "wherein", "herein",
    "aforesaid", "accordingly", "furthermore", "moreover", "notwithstanding", "inasmuch", "whosoever", "whatsoever",
]
JUNK_OPENINGS = r"^(?:occ:|age:|high court|honourable the)"
# Dispositions that say nothing.
NO_DISPOSITION = [
    "JHARKHAND", "BOGUS", "VERIFY", "PREMPTORY", "PEREMPTORY", "INTERM  ORDER", "HEARD", "ADDL. GROUND", "EXPEDEDIT", "ADJUDICATED",
    "FOR PURPOSE OF COMPLIANCE", "IA/MEMO/VK/OP IN DISPOSAL", "IA DISPOSED", "SCHEME SANCTIONED - COMPANY", "COMPANY WOUND UP",
    "SPEAKING TO MINUTES", "AG AND OT", "DECIDED CASE", "HEARING ADJOURNED", "PROCEEDINGS CLOSED/DROPPED",
]
# Dispositions by how they are written in upper case, tried in this order.
DISPOSITIONS = [
    (r"^DISPOS(?:ED|SED|AL)", "DISPOSED OF"),
    (r"PARTLY (?:ALLOWED|SUCCESS)", "PARTLY ALLOWED"),
    (r"^(?:CASE )?ALLOWED|^APPEAL(?:\(S\)| IS) ALLOWED|^PETITION IS ALLOWED|^(?:APPLICATION|APPEAL) ALLOWED$|^APPEAL ALLOWED/REVERSED$", "ALLOWED"),
    (r"^ADMITTED.*(?:ALLOWED|GRANTED)|^LEAVE GRANTED & ALLOWED", "ALLOWED"),
    (r"^DISMISS?ED.*(?:INFRUCTUOUS|INFRACTUOUS|INFRACTOUS)", "DISMISSED AS INFRUCTUOUS"),
    (r"^(?:DISMISS|DISSMISS|DISMISED).*(?:DEFAULT|NON)", "DISMISSED FOR DEFAULT"),
    (r"^DISMISS?ED.*(?:WITHDRAWN|WITHDRAWAL)", "WITHDRAWN"),
    (r"^DISMISS?ED.*ABATED", "ABATED"),
    (r"^DISMISS?ED.*SETTLED", "SETTLED"),
    (r"^(?:DISMISS|DISSMISS|DISMISED)", "DISMISSED"),
    (r"^D\.F\.D", "DISMISSED FOR DEFAULT"),
    (r"^APPEAL (?:IS )?DISMISSED|^APPEAL CONFIRMED$", "DISMISSED"),
    (r"^REJECTED", "REJECTED"),
    (r"^QUASHED$", "QUASHED"),
    (r"^NOT[- ]PRESSED|WITHDRAWN", "WITHDRAWN"),
    (r"^BAIL$|^BAIL GRANTED|^PROVISIONAL BAIL$|ANTICIPAT.*BAIL|BAIL.*ANTICIPAT|^INTERIM BAIL$|^BAIL IN PART$", "BAIL GRANTED"),
    (r"BAIL (?:REJECTED|CANCELLED)", "BAIL REJECTED"),
    (r"^CLOSED|^CONSIGNED", "CLOSED"),
    (r"REMAND|REMITTED", "REMANDED"),
    (r"SETTLED|COMPROM|CONSENT TERM|LOK ADALAT|MEDIATION|COMPOUNDED", "SETTLED"),
    (r"^ACQUITTED$", "ACQUITTED"),
    (r"^CONVICTED$", "CONVICTED"),
    (r"^TRANSFER|^TRANSFRD|^RE-TRANSFERRED|^R AND P TRANSFERED", "TRANSFERRED"),
    (r"ABATED", "ABATED"),
    (r"INFRUCTU|INFRACTU|INFRACTOUS", "DISMISSED AS INFRUCTUOUS"),
    (r"^DECREE|^EX-PARTE DECREE", "DECREED"),
    (r"^(?:GRANTED|GRANT ISSUED|APPLICATION GRANTED)$|^LEAVE GRANTED|^LEAVE TO APPEAL", "GRANTED"),
    (r"^STAY", "STAYED"),
    (r"^ORDERED|^DIRECTION|^JUDGEMENT$", "ORDERED"),
    (r"LARGER BENCH", "REFERRED TO LARGER BENCH"),
    (r"^REFERENCE ANSWERED|^ANSWERED", "REFERENCE ANSWERED"),
    (r"RULE.*ABSOLUTE|ABSOLUTE.*RULE", "RULE MADE ABSOLUTE"),
    (r"RULE.*DISCHARGED|DISCHARGED.*RULE", "RULE DISCHARGED"),
    (r"^ABSOLUTE$|^PETITION MADE ABSOLUTE|^INJUNCTION MADE ABSOLUTE$", "RULE MADE ABSOLUTE"),
    (r"^DISCHARGED$", "DISCHARGED"),
    (r"^MODIFIED|^ORDER MODIFIED$|^MODIFICATION$", "MODIFIED"),
    (r"^SET ASIDE|^REVERSED$", "SET ASIDE"),
    (r"^DROPPED$", "DROPPED"),
    (r"^RELAXED$", "RELAXED"),
    (r"^CONVERTED", "CONVERTED"),
    (r"^CONFIRMED$", "CONFIRMED"),
    (r"^REVOKED$", "REVOKED"),
    (r"^CLARIFIED$", "CLARIFIED"),
    (r"^AMOUNT AWARDED$", "ALLOWED"),
    (r"^NON PROSECUTION", "DISMISSED FOR DEFAULT"),
    (r"OTHERS? DISPOSED|C\.A\. DISPOSED|REFERENCE DISPOSED", "DISPOSED OF"),
]
# Registry codes of courts; Madras has two.
COURTS = {
    "BRHC": "Patna", "UPHC": "Allahabad", "HCBM": "Bombay", "RJHC": "Rajasthan", "KLHC": "Kerala", "HBHC": "Telangana", "HCMA": "Madras", "HCMD": "Madras",
    "PHHC": "Punjab and Haryana", "KAHC": "Karnataka", "MPHC": "Madhya Pradesh", "CGHC": "Chhattisgarh", "JHHC": "Jharkhand", "GJHC": "Gujarat",
    "WBCH": "Calcutta", "DLHC": "Delhi", "GAHC": "Gauhati", "APHC": "Andhra Pradesh", "HPHC": "Himachal Pradesh", "UKHC": "Uttarakhand",
    "JKHC": "Jammu and Kashmir", "TRHC": "Tripura", "MNHC": "Manipur", "MLHC": "Meghalaya", "SKHC": "Sikkim", "ODHC": "Orissa",
}


def head(text: Column) -> Column:
    return clean_ocr(F.substring(text, 1, HEAD))


def end(text: Column) -> Column:
    return clean_ocr(F.when(F.length(text) > END, F.substring(text, -END, END)).otherwise(text))


def decision_date(header: Column, upper: Column | None = None) -> Column:
    """ISO date of the first pattern that gives a day to 31 and a year from 1900 to 2100; two-digit years below 50 are of this century.

    Days aren't held against their month, so the 31st of February stays as it is written.
    """
    names = {name: k for k, full in enumerate(MONTHS, 1) for name in (full, full[:3])} | {"sept": 9}
    by_name = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))

    def of(pattern: str, groups: str) -> Column:
        def read(hit: Column) -> Column:
            part = {g: F.regexp_extract(hit, pattern, k) for k, g in enumerate(groups, 1)}
            day, year = part["D"].try_cast("int"), part["Y"].try_cast("int")
            year = F.when(year < 100, year + F.when(year < 50, 2000).otherwise(1900)).otherwise(year)
            month = F.try_element_at(by_name, F.lower(part["W"])) if "W" in groups else part["M"].try_cast("int")
            valid = (month != 0) & day.between(1, 31) & year.between(1900, 2100)
            return F.when(valid, F.format_string("%04d-%02d-%02d", year, month, day))

        return F.when(matches(header, pattern, upper), _let(F.regexp_substr(header, F.lit(pattern)), read))

    return F.coalesce(*(of(p, g) for p, g in DATES))


def case_type(header: Column, upper: Column | None = None) -> Column:
    return first_match(header, CASE_TYPES, upper=upper)


def case_number(header: Column) -> Column:
    def of(pattern: str, groups: int) -> Column:
        def read(hit: Column) -> Column:
            parts = [F.regexp_extract(hit, pattern, k + 1) for k in range(groups)]
            return F.when(parts[0] != "", F.concat_ws(" of ", *parts))

        return _let(F.regexp_substr(header, F.lit(pattern)), read)

    return F.coalesce(*(of(p, n) for p, n in CASE_NUMBERS))


def jurisdiction(header: Column, kind: Column, upper: Column | None = None) -> Column:
    """By the header, or else by the case's type; null where neither says."""
    return F.coalesce(first_match(header, JURISDICTIONS, upper=upper), F.when(header != "", first_match(kind, JURISDICTION_OF_TYPE)))


def outcome(footer: Column, upper: Column | None = None) -> Column:
    return first_match(footer, OUTCOMES, upper=upper)


def bench_type(header: Column) -> Column:
    return first_match(header, BENCHES)


def _first_of_each(rows: Column, key: Callable[[Column], Column]) -> Column:
    """The elements whose key no earlier element has."""
    keys = F.transform(rows, key)
    return F.filter(rows, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def acts_cited(text: Column, most: int = 20) -> Column:
    """The first ``most`` different (section, act) that a text cites; acts differ without regard to case."""

    def read(hit: Column) -> Column:
        return F.struct(F.trim(F.regexp_extract(hit, ACT, 1)).alias("section"), F.regexp_replace(collapse(F.regexp_extract(hit, ACT, 2)), r"[., ]+$", "").alias("act"))

    cited = F.transform(F.regexp_extract_all(text, F.lit(ACT), 0), read)
    long_enough = F.filter(cited, lambda c: F.length(c["act"]) > 3)
    return _let(long_enough, lambda rows: F.slice(_first_of_each(rows, lambda c: F.concat_ws("|", c["section"], F.lower(c["act"]))), 1, most))


def articles_cited(text: Column, most: int = 10) -> Column:
    found = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(ARTICLE), 1), lambda x: F.trim(x)))
    return F.slice(F.transform(found, lambda x: F.concat(F.lit("Article "), x)), 1, most)


def metadata(text: Column) -> Column:
    """A struct of what a judgment's head, end and body say about it; null members where they say nothing.

    Head and end are cleaned once a text, and each rule set looks at the result.
    """

    def of(ends: Column) -> Column:
        header, upper = ends["header"], ends["upper"]

        def rest(kind: Column) -> Column:
            return F.struct(
                decision_date(header, upper).alias("decision_date"),
                kind.alias("case_type"),
                case_number(header).alias("case_number"),
                jurisdiction(header, kind, upper).alias("jurisdiction"),
                bench_type(header).alias("bench_type"),
                outcome(ends["footer"], ends["last"]).alias("disposal_status"),
                acts_cited(text).alias("acts_cited"),
                articles_cited(text).alias("articles_cited"),
            )

        return _let(case_type(header, upper), rest)

    def with_upper(ends: Column) -> Column:
        return F.struct(ends["header"].alias("header"), F.upper(ends["header"]).alias("upper"), ends["footer"].alias("footer"), F.upper(ends["footer"]).alias("last"))

    return _let(_let(F.struct(head(text).alias("header"), end(text).alias("footer")), with_upper), of)


def full_metadata(text: Column) -> Column:
    """All of ``metadata`` and of ``people.people`` in one struct, the head cleaned once for both."""
    from . import people

    def joined(parts: Column) -> Column:
        names = ["decision_date", "case_type", "case_number", "jurisdiction", "bench_type", "disposal_status", "acts_cited", "articles_cited"]
        others = ["judges", "petitioner", "respondent", "petitioner_advocates", "respondent_advocates", "court", "lower_court", "first_report"]
        return F.struct(*(parts["m"][n].alias(n) for n in names), *(parts["p"][n].alias(n) for n in others), F.size(parts["p"]["judges"]).alias("bench_strength"))

    return _let(F.struct(metadata(text).alias("m"), _let(head(text), lambda h: people.people(text, h)).alias("p")), joined)


def is_judge(name: Column, court_type: Column) -> Column:
    """Whether a name can be a judge's; a high court's needs a title or two capitalised words."""
    lower = F.lower(F.trim(name))
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    capitals = F.size(F.filter(words, lambda w: w.rlike(r"^\p{Lu}")))
    named = lower.contains("justice") | lower.contains("j.") | ((capitals >= 2) & (F.length(name) >= 5))
    possible = (F.length(name) >= 3) & ~name.rlike(r"^\d+$") & ~lower.isin(JUNK_NAMES) & ~lower.rlike(JUNK_OPENINGS)
    return F.coalesce(possible & ((F.coalesce(court_type, F.lit("")) != "high_court") | named), F.lit(False))


def disposition(raw: Column) -> Column:
    """A disposition under its canonical name; null for internal codes, noise and what is longer than 60 characters."""
    upper = F.upper(F.trim(raw))
    nothing = upper.rlike(r"^\d\d.?-|@ ADM|@ FH") | upper.isin(NO_DISPOSITION) | (F.length(upper) > 60)
    return F.when(~nothing, first_match(upper, [(f"(?s){p}", v) for p, v in DISPOSITIONS]))


def court_name(case_id: Column) -> Column:
    """The high court of a case by its id's first four letters; null for other codes."""
    names = F.create_map(*(F.lit(x) for code, name in COURTS.items() for x in (code, f"{name} High Court")))
    return F.try_element_at(names, F.substring(case_id, 1, 4))


def court_slug(name: Column) -> Column:
    return F.replace(F.replace(F.lower(name), F.lit(" high court"), F.lit("")), F.lit(" "), F.lit("-"))
