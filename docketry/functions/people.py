"""Columns on who a judgment names: judges, parties, advocates; and the court below, first reports, headnotes.

Patterns are tried in order; what one finds is cleaned and must be valid, or the next is tried.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .redaction import _let
from .text import collapse, strip

# What parts two parties, the part of a text it is looked for in, and how far their lines may stand from it.
VERSUS = "(?imd)" + "|".join(
    [
        r"(?:^|\n)\s*[-—]*\s*(?:Versus|VERSUS)\s*[-—]*\s*(?:\n|$)",
        r"(?:^|\n)\s*[-—]*\s*V\s*/\s*[Ss]\s*[-—]*\s*(?:\n|$)",
        r"(?:^|\n)\s*[-—]*\s*Vs\.?\s*[-—]*\s*(?:\n|$)",
        r"(?:^|\n)\s*[-—]*\s*V\.\s*S\.?\s*[-—]*\s*(?:\n|$)",
        r"\.{2,}\s*Versus\s*\.{2,}",
        r"\.{2,}\s*V/s\s*\.{2,}",
        r"\.{2,}\s*Vs\.?\s*\.{2,}",
        r"\s+Versus\s+",
        r"\s+V/s\s+",
        r"\s+Vs\.?\s+",
        r"\s+v\.\s+",
    ]
)
SEARCHED, NEAR, LONGEST_PARTY = 5000, 1500, 200
# Lines that are no party's name.
NOT_PARTIES = "(?i)" + "|".join(
    [
        "^```", r"^#{1,6}\s", r"^\|", r"^\*\*", r"^&\s*Ors?\.?", r"^&\s*Others", r"^&\s*Anr\.?", r"^&\s*Another", r"Petitioners?\s*$", r"Respondents?\s*$", r"Appellants?\s*$", r"Applicants?\s*$", r"Complainants?\s*$",
        r"Accused\s*$", r"\.{3,}\s*Petitioner", r"\.{3,}\s*Respondent", r"\.{3,}\s*Appellant", "^IN THE HIGH COURT", "^HIGH COURT", r"^BEFORE[:\s]", r"^HON[\.']", "^CORAM", "^PRESENT", r"^DATE\s*:", r"^\d+$", r"^Page\s",
        "^-{3,}$", r"^\*{3,}$", "^#{2,}", r"^\[.*\]$", "^CRIMINAL", "^CIVIL", "^WRIT", "^APPEAL", "^PETITION", r"^CASE\s*NO", "^JUDGMENT", r"^ORDER\s", "^RESERVED", "^PRONOUNCED", "^AT BOMBAY", "^AT DELHI", "^AT MADRAS",
        "^BENCH", "JURISDICTION", r"^No\.\s", r"^Crl\.", r"^W\.P\.", r"^C\.A\.", r"^\(.*\)$", "^FARAD", "^Office", "^Court.*order", "^Registrar", r"^Mr\.\s+\w+\s+for", r"^Mrs\.\s+\w+\s+for", r"^Shri\s+\w+\s+for",
        r"^Smt\.\s+\w+\s+for", r"for\s+(?:the\s+)?(?:petitioner|respondent|appellant)", "^Advocate", r"^SMT\.", "^SEPTEMBER|^OCTOBER|^NOVEMBER|^DECEMBER|^JANUARY|^FEBRUARY|^MARCH|^APRIL|^MAY|^JUNE|^JULY|^AUGUST",
        r"^\d{1,2}[/-]\d{1,2}[/-]\d{2,4}", r"^P\.C\.", "^Through", "^AND$", "^WITH$", "^IN$",
    ]
)
# What is taken off a line that names a party, in this order.
PARTY_CLEANING = [
    ("^```+", ""), ("```+$", ""), (r"^#+\s*", ""), (r"\*\*([^*]+)\*\*", "$1"),
    (r"(?i)\.{2,}\s*(?:Petitioner|Appellant|Applicant|Complainant)s?.*$", ""), (r"(?i)\.{2,}\s*(?:Respondent|Accused|Opposite\s*Party|Defendant)s?.*$", ""), (r"\s*\.{2,}\s*$", ""),
    (r"(?i)\s*:\s*(?:Petitioner|Respondent|Appellant|Applicant)s?\s*$", ""), (r"(?i)\s+(?:Petitioner|Respondent|Appellant|Applicant|Complainant)s?\s*$", ""), (r"^\s*[\d.)(\s]+", ""), (r"[*#|`]+", ""), (r"(?U)\s+", " "),
]
PARTY_TRIMMED, ROLES, OTHERS = ".,;:-*#()[]` ", ["petitioner", "respondent", "appellant", "applicant", "accused", "complainant"], r"(?i)^&\s*(?:ors?|others?|anr|another)$"
PARTY_LAST_CLEANING = [
    (r"^[=\-_*#\s]+", ""), (r"(?i)^(?:\s*<br\s*/?>)+", ""), (r"^\s*\(?\d+\)?[.)\s]+", ""), (r"(?i)\s*\.{2,}\s*(?:Petitioner|Appellant|Respondent|Applicant|Complainant)s?\s*$", ""), (r"(?U)\s+", " "),
]
# Parties on one line, where nothing parts them on lines of their own.
PARTIES = [
    r"(?im)(.+?)\s*\.{2,}\s*(?:Petitioner|Appellant|Complainant)s?\s+(?:Versus|Vs\.?|V\.)\s+(.+?)\s*\.{2,}\s*(?:Respondent|Accused|Opposite\s+Party)",
    r"(?im)^(.+?)\s+(?:Versus|Vs\.?|V\.)\s+(.+?)$",
    r"(?i)(.+?)\s+-vs-\s+(.+)",
]
RESPONDENT = r"(?im)(?:Versus|Vs\.?|V\.)\s*\n?\s*([A-Z][A-Za-z\s\.]+?)\s*\.{2,}\s*(?:Respondent|Accused|Opposite\s+Party)"
LINE_CLEANING = [
    (r"\*+", ""), (r"#+\s*", ""), ("`+", ""), (r"^\d+\.\s*", ""), (r"\s*\.{2,}\s*$", ""), (r"(?U)\s+", " "), (r"(?i)\s*[:\-]+\s*(?:Petitioner|Appellant|Applicant|Respondent|Accused|Opposite\s+Party)s?\s*$", ""),
]
NOT_LINES = (
    r"(?i)^(?:Chandigarh|Kadapa|Delhi|Mumbai|Chennai|Kolkata|Bengaluru)\.?\s*$|^(?:State|Government|Union)\s+of\s*$|^(?:The|In|At|Of|And)\s*$|,\s*J\.?\]?\s*$|^JUSTICE\s|^HON'?BLE\s|^IN\s+THE\s+HIGH\s+COURT|^\d+-\s*IN\s+THE"
)
# What no name is; connectors that none begins or ends with; words of judgments, of which a name has few.
NOT_NAMES = r"(?i)^\s*(?:the|of|and|in|at)\s*$|\d{4,}|^[^A-Za-z]+$|^this\s+court|^of\s+this"
OPENING, ENDING = "^(?:and|the|of|in|at|to|for|by|is|was|has|learned) ", " (?:and|the|of|in|at|to|for|by|is|was)$"
JUDGMENT_WORDS = (
    "learned counsel submitted contended argued pleaded consideration circumstances therefore accordingly hence heard perused considered examined reviewed analyzed petition appeal application petitioner respondent appellant "
    "accused complainant prosecution defence defense evidence witness testimony aggrieved dissatisfied impugned challenged prayed submissions contentions averments allegations grounds question issue matter case facts before "
    "present appearing appeared against under pursuant accordance respect common questions law similar analogous that this which where when while being advocate for the and state of acquittal conviction sentenced ordered "
    "passed dismissed"
).split()
JUDGMENT_SHARE, LOWER_SHARE = 0.4, 0.7
# Judges, tried in this order; what parts their names, what is taken off them, and what they aren't.
_TO_ORDER = r"(?=\s*DATE\s*:|DATED\s*:|ORDER|JUDGMENT|\n\s*\n)"
JUDGES = [
    r"(?is)CORAM\s*:\s*(.+?)" + _TO_ORDER,
    r"(?is)BENCH\s*:\s*(.+?)" + _TO_ORDER,
    r"(?is)Before\s*:?\s*(.+?)" + _TO_ORDER,
    r"(?i)HON'?BLE\s+(?:MR\.?\s+)?(?:JUSTICE|JUDGE)\s+([A-Z][A-Z\s\.,]+?)(?:\s+AND\s+HON'?BLE\s+(?:MR\.?\s+)?(?:JUSTICE|JUDGE)\s+([A-Z][A-Z\s\.,]+?))?(?=\s*\n|DATED|DATE|$)",
    r"(?i)HON'?BLE\s+(?:MR\.?\s+)?(?:JUSTICE|JUDGE)\s+([A-Z][A-Z\s\.,]+?)(?=\s+AND\s+|\s*,\s*HON|\n|$)",
    r"(?m)(?:^|\n)\s*(?:JUSTICE|JUDGE)\s+([A-Z][A-Z\s\.,]+?)(?=\s+AND\s+|\n|$)",
    r"(?m)\(([A-Z][A-Z\s\.,]+,\s*J\.?)\)\s*$",
]
JUDGE_PARTS = r"(?i)\s+AND\s+|\s*&\s*|,\s*(?=[A-Z])"
JUDGE_CLEANING = [
    (r"(?i)^CORAM\s*:\s*", ""), (r"(?i)^BENCH\s*:\s*", ""), (r"(?i)^Before\s*:\s*", ""), (r"(?U)\s+", " "), (r"(?i)^\s*HON'?BLE\s+", ""), (r"(?i)^\s*(?:MR|MS|MRS|SMT|SHRI)\.?\s+", ""),
    (r"(?i)^\s*JUSTICE\s+", ""), (r"(?i)^\s*JUDGE\s+", ""), (r"(?i),?\s*J\.?\s*$", ""), (r"(?i),?\s*JJ\.?\s*$", ""), (r"\s*\(.*?\)\s*", ""),
]
NOT_JUDGES = (
    r"(?i)division\s*bench|single\s*bench|full\s*bench|^the\s|^by\s+an|^this\s+court|^learned|^\d|^para|^page|^order|^in\s+connection|police\s+station|p\.?s\.?\s+case|case\s+no|fir\s+no|crime\s+no|^at\s+|^on\s+|industrial|industerial|registered"
)
MOST_WORDS = 5
# Advocates of either side, tried in this order.
_TITLE, _NAME, _FOR = r"(?:Mr\.?|Mrs\.?|Ms\.?|Shri\.?|Smt\.?)", r"([A-Z][A-Za-z\.\s]+?)", r"(?:the\s+)?"
_COUNSEL = r"(?:,?\s*(?:learned\s+)?(?:Senior\s+)?(?:Counsel|Advocate|A\.?S\.?G\.?)?)"
_SHORT_TITLE, _SHORT_NAME = r"(?:Mr\.|Mrs\.|Ms\.|Shri|Smt\.?)", r"([A-Z][a-zA-Z\.\s]{3,40}?)"
PETITIONERS_ADVOCATES = [
    rf"(?i)For\s+{_FOR}(?:Petitioner|Appellant)\s*[:\-]\s*(?:Mr\.?|Mrs\.?|Ms\.?|Shri\.?|Smt\.?|Adv\.?)?\s*{_NAME}(?:\s*,|\s*$|\s+(?:Advocate|Counsel))",
    rf"(?i)(?:Mr\.?|Mrs\.?|Ms\.?|Shri\.?|Smt\.?|Adv\.?|Dr\.?)\s+{_NAME}{_COUNSEL}\s+(?:appearing\s+)?for\s+{_FOR}(?:petitioner|appellant|applicant)",
    rf"(?i){_TITLE}\s+{_NAME},?\s+(?:learned\s+)?(?:counsel|advocate)\s+for\s+{_FOR}(?:petitioner|appellant)",
    rf"(?i)(?:Petitioner|Appellant)'?s?\s+(?:Counsel|Advocate)\s*[:\-]\s*{_TITLE}?\s*{_NAME}(?:\s*,|\s*$)",
    rf"(?i){_SHORT_TITLE}\s+{_SHORT_NAME}\s+(?:i/b\s+[^\n]+?\s+)?for\s+{_FOR}(?:petitioner|appellant|applicant)",
    rf"(?i)([A-Z][a-zA-Z\.\s]{{5,40}}?),?\s+(?:Advocate|Adv\.?|APP|AGP)\s+for\s+{_FOR}(?:petitioner|appellant|applicant)",
]
RESPONDENTS_ADVOCATES = [
    rf"(?i)For\s+{_FOR}(?:Respondent|State|Opposite\s+Party)\s*[:\-]\s*(?:Mr\.?|Mrs\.?|Ms\.?|Shri\.?|Smt\.?|Adv\.?)?\s*{_NAME}(?:\s*,|\s*$|\s+(?:Advocate|Counsel))",
    rf"(?i)(?:Mr\.?|Mrs\.?|Ms\.?|Shri\.?|Smt\.?|Adv\.?|Dr\.?)\s+{_NAME}{_COUNSEL}\s+(?:appearing\s+)?for\s+{_FOR}(?:respondent|opposite\s+party|state|defendant)",
    rf"(?i){_TITLE}\s+{_NAME},?\s+(?:learned\s+)?(?:counsel|advocate)\s+for\s+{_FOR}(?:respondent|state)",
    rf"(?i)(?:A\.?P\.?P\.?|Additional\s+Public\s+Prosecutor|Public\s+Prosecutor)\s*[:\-]?\s*{_TITLE}?\s*{_NAME}(?:\s*,|\s*$)",
    rf"(?i)(?:Respondent|State)'?s?\s+(?:Counsel|Advocate)\s*[:\-]\s*{_TITLE}?\s*{_NAME}(?:\s*,|\s*$)",
    rf"(?i){_SHORT_TITLE}\s+{_SHORT_NAME}\s+(?:i/b\s+[^\n]+?\s+)?for\s+{_FOR}(?:respondent|state|accused)",
    rf"(?i)([A-Z][a-zA-Z\.\s]{{5,40}}?),?\s+(?:Advocate|Adv\.?|APP|AGP)\s+for\s+{_FOR}(?:respondent|state|accused)",
]
NO_ADVOCATES, NOT_ADVOCATES = ["none", "advocate", "adv", "the", "mr", "mrs", "ms"], r"(?i)^(?:for|the|petitioner|respondent|appearing|learned|counsel)(?: |$)"
ADVOCATE_CLEANING = [
    (r"(?i)\s+(?:for|advocate|adv|app|agp).*$", ""), (r"^\s+|\s+$", ""), (r"(?i),?\s*(?:learned\s+)?(?:Senior\s+)?(?:Counsel|Advocate|A\.?S\.?G\.?)?\s*$", ""), (r"(?i)^(?:Mr\.?|Mrs\.?|Ms\.?|Shri\.?|Smt\.?|Adv\.?|Advocate|Dr\.?)\s*", ""),
    (r"(?U)\s+", " "), (r"^\s+|\s+$", ""), (r"[.,;:]+$", ""),
]
# Courts below, tried in this order, and which are none or must be long to be one.
_BELOW = r"([A-Za-z\s]+(?:Court|Tribunal|Judge|Magistrate"
LOWER_COURTS = [
    rf"(?i)(?:order|judgment|decree|award)\s+(?:passed\s+)?(?:by|of)\s+{_FOR}(?:Learned\s+)?(?:Hon'?ble\s+)?{_BELOW}|Authority|Commission|Board))",
    rf"(?i)(?:impugned|challenged|appealed)\s+(?:order|judgment|decree)\s+(?:of\s+)?{_FOR}(?:Learned\s+)?{_BELOW}))",
    rf"(?i)(?:appeal|revision)\s+(?:against|from)\s+{_FOR}(?:order\s+of\s+)?{_FOR}(?:Learned\s+)?{_BELOW}))",
]
NO_LOWER_COURTS, NOT_LOWER_COURTS = ["this court", "high court", "the court", "court below", "lower court"], "learned|acquittal|conviction|recorded by|passed by|made by"
KINDS_OF_COURT = "district|sessions|magistrate|tribunal|civil|family|labour|consumer|munsiff|munsif|additional"
# Numbers of first reports, tried in this order, with how many groups.
FIRST_REPORTS = [
    (r"(?i)(?:FIR|First\s+Information\s+Report)\s*(?:No\.?)?\s*:?\s*(\d+(?:/\d+)?)\s*(?:of\s*)?(\d{4})?", 2),
    (r"(?i)(?:Crime|CR|C\.?R\.?)\s*(?:No\.?)?\s*:?\s*(\d+(?:/\d+)?)\s*(?:of\s*)?(\d{4})?", 2),
    (r"(?i)(?:Police\s+Station)\s+[A-Za-z\s]+\s+(?:Crime|FIR)\s*(?:No\.?)?\s*(\d+(?:/\d+)?)", 1),
    (r"(?i)P\.?S\.?\s*(?:Case)?\s*No\.?\s*[-:]?\s*(\d+)\s*(?:of|Year)?\s*[-:]?\s*(\d{4})?", 2),
]
HEADNOTE = r"(?is)(?:HEADNOTE|HEAD\s*NOTE|SUMMARY)\s*[:\-]?\s*(.{100,500}?)(?=\n\n|\n[A-Z]{3,}|\n\d+\.)"
# Names of high courts in a head, and the places they are known by, in this order.
COURT_NAMES = [r"(?i)HIGH\s+COURT\s+(?:OF\s+)?(?:JUDICATURE\s+)?(?:AT\s+|FOR\s+)([A-Z][A-Za-z]+)", r"(?i)([A-Z][A-Za-z]+)\s+HIGH\s+COURT"]
PLACES = (
    "bombay delhi madras calcutta allahabad andhra telangana karnataka kerala punjab haryana gujarat rajasthan madhya chhattisgarh jharkhand bihar orissa odisha assam gauhati guwahati patna lucknow hyderabad bangalore chennai "
    "mumbai kolkata amaravati jabalpur nagpur aurangabad panaji goa sikkim manipur meghalaya tripura uttarakhand himachal jammu kashmir srinagar chandigarh cuttack"
).split()


def _cleaned(text: Column, steps: Sequence[tuple[str, str]]) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{L}", ""))


def _first(items: Column, ok: Callable[[Column], Column]) -> Column:
    """The first element that is ok; null without one."""
    return F.get(F.filter(items, ok), F.lit(0))


def _first_of(items: Sequence[Column], ok: Callable[[Column], Column]) -> Column:
    """The first of ``items`` that is ok; those behind it aren't computed."""
    return F.coalesce(*(_let(item, lambda x: F.when(ok(x), x)) for item in items))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def is_prose(text: Column) -> Column:
    """Whether a text is rather a judgment's prose than a name: by connectors at its ends, words of judgments, or lower-case words."""
    lower = F.lower(strip(text))

    def of(words: Column) -> Column:
        prose = F.filter(words, lambda w: F.btrim(F.lower(w), F.lit(".,;:")).isin(JUDGMENT_WORDS))
        small = F.filter(words, lambda w: (w == F.lower(w)) & w.rlike(r"\p{L}") & (F.length(w) > 2))
        n = F.size(words)
        return ((n >= 3) & (F.size(prose) > n * JUDGMENT_SHARE)) | ((n > 3) & (F.size(small) > n * LOWER_SHARE))

    return F.coalesce((text == "") | lower.rlike(OPENING) | lower.rlike(ENDING) | _let(_words(text), of), F.lit(True))


def is_name(text: Column, least: int = 3, most: int = 100) -> Column:
    """Whether a text can be a name: its length, a share of ASCII letters of 0.3 and more, and no prose."""
    letters = F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    return F.coalesce(F.length(text).between(least, most) & (letters > 0) & (letters >= F.length(text) * 0.3) & ~text.rlike(NOT_NAMES) & ~is_prose(text), F.lit(False))


def party_name(line: Column) -> Column:
    """The party that a line names; null where it names none."""

    def last(name: Column) -> Column:
        out = strip(_cleaned(name, PARTY_LAST_CLEANING))
        return F.when((F.length(out) >= 3) & (_letters(out) >= 3), F.substring(out, 1, LONGEST_PARTY))

    def valid(name: Column) -> Column:
        named = (F.length(name) > 2) & ~F.lower(name).isin(ROLES) & ~name.rlike(OTHERS)
        return F.when(named & (F.length(name) <= 250) & ~name.rlike(NOT_PARTIES) & (_letters(name) >= F.greatest(F.lit(3.0), F.length(name) * 0.25)), _let(name, last))

    return _let(F.btrim(strip(_cleaned(line, PARTY_CLEANING)), F.lit(PARTY_TRIMMED)), valid)


def _party_of_line(name: Column) -> Column:
    """A party from a pattern on one line."""

    def valid(out: Column) -> Column:
        short = F.when(F.length(out) > LONGEST_PARTY, F.concat(F.substring(out, 1, LONGEST_PARTY), F.lit("..."))).otherwise(out)
        return F.when(is_name(short, 4, 150) & ~short.rlike(NOT_LINES), short)

    return _let(F.btrim(_cleaned(strip(name), LINE_CLEANING), F.lit("., :-()")), valid)


def parties(text: Column, header: Column) -> Column:
    """A struct (petitioner, respondent): the last valid line before what parts them and the first after it.

    Where nothing in the text's first characters parts them, patterns on the cleaned
    ``header`` are tried.  Members are null where nothing valid is found.
    """

    def nearest(lines: Column) -> Column:
        # lines behind the first that names one aren't looked at
        return F.aggregate(F.filter(F.transform(lines, strip), lambda x: x != ""), F.lit(None).cast("string"), lambda name, line: F.coalesce(name, party_name(line)))

    def split(halves: Column) -> Column:
        before, after = F.get(halves, F.lit(0)), F.get(halves, F.lit(1))
        # Spark's right() of a text shorter than that is the text
        return F.struct(nearest(F.reverse(F.split(F.right(before, F.lit(NEAR)), "\n"))).alias("petitioner"), nearest(F.split(F.left(after, F.lit(NEAR)), "\n")).alias("respondent"))

    def on_one_line(head: Column) -> Column:
        p, r = ([_party_of_line(F.nullif(F.regexp_extract(head, x, g), F.lit(""))) for x in PARTIES] for g in (1, 2))
        alone = _party_of_line(F.nullif(F.regexp_extract(head, RESPONDENT, 1), F.lit("")))

        def answered(k: int, name: Column) -> Column:
            return F.struct(name.alias("petitioner"), F.coalesce(*reversed(r[: k + 1]), alone).alias("respondent"))

        def tried(k: int) -> Column:
            # each pattern is tried once, and only where those before found nobody
            return _let(p[k], lambda name: answered(k, name) if k == len(PARTIES) - 1 else F.when(name.isNotNull(), answered(k, name)).otherwise(tried(k + 1)))

        return tried(0)

    searched = F.coalesce(F.nullif(F.substring(text, 1, SEARCHED), F.lit("")), header)
    # one search both tells whether something parts them and parts them
    return _let(F.split(searched, VERSUS, 2), lambda halves: F.when(F.coalesce(F.size(halves) > 1, F.lit(False)), split(halves)).otherwise(_let(F.coalesce(header, F.lit("")), on_one_line)))


def judges(header: Column) -> Column:
    """Names of judges in a cleaned header, by the first pattern that gives a valid one; an empty array without any."""

    def named(raw: Column) -> Column:
        names = F.transform(F.split(strip(raw), JUDGE_PARTS), lambda x: F.btrim(_cleaned(strip(x), JUDGE_CLEANING), F.lit(" \t\n:-.,")))
        return F.filter(names, lambda x: is_name(x, 4, 50) & ~x.rlike(NOT_JUDGES) & (F.size(_words(x)) <= MOST_WORDS))

    found = (_let(F.regexp_extract(F.coalesce(header, F.lit("")), p, 1), lambda x: F.when(x != "", named(x))) for p in JUDGES)
    return F.coalesce(_first_of(list(found), lambda x: F.size(x) > 0), F.array().cast("array<string>"))


def advocate(header: Column, patterns: Sequence[str]) -> Column:
    """The advocate that the first pattern with a plausible name gives; null without one."""

    def plausible(x: Column) -> Column:
        return F.length(x).between(4, 49) & ~F.lower(x).isin(NO_ADVOCATES) & x.rlike("[A-Za-z]{3,}")

    found = [strip(F.regexp_extract(header, p, 1)) for p in patterns]
    return _let(_cleaned(_first_of(found, plausible), ADVOCATE_CLEANING), lambda x: F.when((F.length(x) >= 3) & ~x.rlike(NOT_ADVOCATES), x))


def advocates(header: Column) -> Column:
    """A struct (petitioner_advocates, respondent_advocates) of arrays of one name at most."""

    def listed(name: Column) -> Column:
        return F.filter(F.array(name), lambda x: x.isNotNull())

    return F.struct(listed(advocate(header, PETITIONERS_ADVOCATES)).alias("petitioner_advocates"), listed(advocate(header, RESPONDENTS_ADVOCATES)).alias("respondent_advocates"))


def lower_court(text: Column) -> Column:
    """The court below of a cleaned text, by the first pattern that gives a valid one."""

    def valid(x: Column) -> Column:
        lower = F.lower(x)
        long_enough = (lower.rlike(KINDS_OF_COURT) | (F.length(x) > 20)) & F.length(x).between(6, 99)
        return ~lower.isin(NO_LOWER_COURTS) & ~lower.rlike(NOT_LOWER_COURTS) & long_enough & is_name(x)

    return _first_of([collapse(F.regexp_extract(text, p, 1)) for p in LOWER_COURTS], valid)


def first_report(text: Column) -> Column:
    """Number of a first information report or crime, with its year behind a slash where it is given."""
    found = [F.concat_ws("/", *(F.nullif(F.regexp_extract(text, p, k), F.lit("")) for k in range(1, n + 1))) for p, n in FIRST_REPORTS]
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in found))


def headnote(text: Column) -> Column:
    """The summary that a text, with its lines, has under that heading."""
    return F.nullif(collapse(F.regexp_extract(text, HEADNOTE, 1)), F.lit(""))


def court_of_header(header: Column) -> Column:
    """The words High Court of, and the first known place in what the header calls the court."""

    def place(x: Column) -> Column:
        return F.when(F.length(x).between(3, 40), _first(F.array(*map(F.lit, PLACES)), lambda p: F.contains(F.lower(x), p)))

    places = F.coalesce(*(_let(F.regexp_extract(header, p, 1), place) for p in COURT_NAMES))
    return F.concat(F.lit("High Court of "), F.initcap(places))


def people(text: Column, header: Column) -> Column:
    """A struct of all that a judgment says on people and courts: judges, parties, advocates, court, court below, first report.

    ``header`` is the cleaned head; members are null (lists empty) where nothing is found, as for null texts.
    """
    whole = collapse(F.coalesce(text, F.lit("")))

    def of(h: Column) -> Column:
        return F.struct(judges(h).alias("judges"), parties(text, h).alias("parties"), advocates(h).alias("advocates"), court_of_header(h).alias("court"))

    def rest(t: Column) -> Column:
        return F.struct(lower_court(t).alias("lower_court"), first_report(t).alias("first_report"))

    def flat(s: Column) -> Column:
        a, b = s["a"], s["b"]
        return F.struct(
            a["judges"].alias("judges"), a["parties"]["petitioner"].alias("petitioner"), a["parties"]["respondent"].alias("respondent"), a["advocates"]["petitioner_advocates"].alias("petitioner_advocates"),
            a["advocates"]["respondent_advocates"].alias("respondent_advocates"), a["court"].alias("court"), b["lower_court"].alias("lower_court"), b["first_report"].alias("first_report"),
        )

    return _let(F.struct(_let(F.coalesce(header, F.lit("")), of).alias("a"), _let(whole, rest).alias("b")), flat)
