"""Classification columns: sections, provisions, languages, status."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Headings of a judgment's sections, tried in this order on each line in upper case.
SECTION_HEADINGS: list[tuple[str, str]] = [
    (r"^(?:IN THE SUPREME COURT|SUPREME COURT OF INDIA)", "header"),
    (r"^(?:IN THE HIGH COURT|HIGH COURT OF)", "header"),
    (r"^(?:BEFORE THE HON)", "header"),
    (r"^(?:RATIO\s+DECIDENDI|RATIO\s+OF\s+THE\s+CASE|RATIO)", "ratio_decidendi"),
    (r"^(?:OBITER\s+DICTA|OBITER\s+DICTUM|OBITER)", "obiter_dicta"),
    (r"^(?:ISSUE[S]?(?:\s+FRAMED)?|QUESTION[S]?\s+(?:FOR\s+)?(?:CONSIDERATION|DETERMINATION)|POINT[S]?\s+(?:FOR\s+)?DETERMINATION)", "issues"),
    (r"^(?:FRAMING\s+OF\s+ISSUE|FORMULATION\s+OF\s+ISSUE)", "issues"),
    (r"^(?:PRECEDENT[S]?\s+(?:CITED|REFERRED|RELIED)|CASE[S]?\s+(?:CITED|REFERRED|RELIED)|CITATION[S]?\s+(?:RELIED|REFERRED))", "precedents"),
    (r"^(?:CASE\s+LAW|JUDICIAL\s+PRECEDENT)", "precedents"),
    (r"^(?:JUDGMENT|ORDER|FINAL\s+ORDER|JUDGEMENT)(?:\s*:)?$", "judgment"),
    (r"^(?:PER\s+CURIAM|DELIVERED\s+BY)", "judgment"),
    (r"^(?:FACTS?|BACKGROUND|FACTUAL\s+(?:BACKGROUND|MATRIX)|BRIEF\s+FACTS)", "facts"),
    (r"^(?:FACTUAL\s+NARRATIVE|STATEMENT\s+OF\s+FACTS)", "facts"),
    (r"^(?:ARGUMENTS?|SUBMISSIONS?|CONTENTIONS?|RIVAL\s+(?:CONTENTIONS?|SUBMISSIONS?))", "arguments"),
    (r"^(?:APPELLANT['S]?\s+(?:ARGUMENTS?|SUBMISSIONS?)|RESPONDENT['S]?\s+(?:ARGUMENTS?|SUBMISSIONS?))", "arguments"),
    (r"^(?:PETITIONER['S]?\s+(?:ARGUMENTS?|SUBMISSIONS?)|DEFENDANT['S]?\s+(?:ARGUMENTS?|SUBMISSIONS?))", "arguments"),
    (r"^(?:LEARNED\s+COUNSEL|SENIOR\s+COUNSEL|ADVOCATE)", "arguments"),
    (r"^(?:DISCUSSION|ANALYSIS|FINDINGS?|REASONING|CONSIDERATION[S]?)", "analysis"),
    (r"^(?:OUR\s+(?:ANALYSIS|VIEW|CONSIDERATION)|COURT['S]?\s+(?:ANALYSIS|VIEW))", "analysis"),
    (r"^(?:WE\s+(?:HAVE\s+)?(?:CONSIDERED|EXAMINED|ANALYZED))", "analysis"),
    (r"^(?:CONCLUSION[S]?|HELD|ORDERED|DIRECTIVE[S]?|DECISION|RESULT)", "conclusion"),
    (r"^(?:IN\s+(?:THE\s+)?(?:RESULT|CONCLUSION)|ACCORDINGLY)", "conclusion"),
    (r"^(?:FOR\s+(?:THE\s+)?(?:FOREGOING|ABOVE)\s+REASONS?)", "conclusion"),
    (r"^(?:RELIEF[S]?\s+(?:SOUGHT|CLAIMED|PRAYED)|PRAYER[S]?)", "relief"),
    (r"^(?:WHEREFORE|THE\s+PETITIONER\s+PRAYS)", "relief"),
    (r"^(?:STATUTE[S]?\s+(?:REFERRED|CITED)|ACT[S]?\s+(?:REFERRED|CITED)|PROVISION[S]?\s+(?:REFERRED|CITED))", "statutes"),
    (r"^(?:RELEVANT\s+(?:STATUTORY\s+)?PROVISIONS?|LEGAL\s+PROVISIONS?)", "statutes"),
    (r"^(?:PROCEDURAL\s+HISTORY|PROCEEDINGS?|HISTORY\s+OF\s+(?:THE\s+)?CASE)", "procedure"),
    (r"^(?:EARLIER\s+PROCEEDINGS?|PRIOR\s+HISTORY)", "procedure"),
    (r"^(?:\d{1,3}\.?\s+)", "paragraph"),
    (r"^(?:[A-Z]\.?\s+)", "section"),
]
# Phrases that tell a section's type where no line has a heading.
SECTION_PHRASES: list[tuple[str, list[str]]] = [
    ("ratio_decidendi", ["RATIO DECIDENDI", "RATIO OF THE CASE", "THE RATIO", "BINDING PRECEDENT", "THIS COURT HOLDS", "WE HOLD THAT"]),
    ("obiter_dicta", ["OBITER DICTA", "OBITER DICTUM", "BY WAY OF OBITER", "OBSERVATION BY WAY OF"]),
    ("issues", ["QUESTION OF LAW", "ISSUE FOR CONSIDERATION", "POINT FOR DETERMINATION", "THE ISSUE THAT ARISES", "THE QUESTION THAT ARISES"]),
    ("facts", ["THE FACTS OF THE CASE", "BRIEFLY STATED THE FACTS", "THE FACTUAL MATRIX"]),
    ("conclusion", ["IN THE RESULT", "IN CONCLUSION", "THE APPEAL IS ALLOWED", "THE APPEAL IS DISMISSED", "THE PETITION IS ALLOWED", "THE PETITION IS DISMISSED", "THE WRIT PETITION"]),
]
# Priorities of section types.
SECTION_PRIORITIES = {
    "ratio_decidendi": 100, "conclusion": 95, "judgment": 90, "analysis": 85, "issues": 80, "obiter_dicta": 75, "arguments": 70, "facts": 65,
    "precedents": 60, "relief": 55, "statutes": 50, "procedure": 45, "header": 40, "paragraph": 35, "section": 35, "body": 30,
}
# Frequent English words, and words of court papers.
ENGLISH_WORDS = (
    "the of and to in a is that for it was on are as with his they be at one have this from or had by not but what all "
    "were when we there can an your which their said if do will each about how up out them "
    "shall court case order section act petition respondent appellant petitioner applicant state"
).split()
# What a legacy Hindi font leaves in Latin letters.
LEGACY_FONT = [
    r"vk[oe]", r"fd;k", r"/kkjk", r"dk;Z", r"djus", r"djrk", r"tkrk", r"gksxk", r"U;k;", r"dksbZ", r"vUrxZr", r"fo}ku", r"iz[kls]", r"i=koyh",
    r"vf/k", r"\bgS\b", r"\bds\b", r"\bdks\b", r"\b;g\b", r"\besa\b", r"\brFkk\b", r"kZ", r"Fkk", r"';",
]
# Words in an act's title or ministry that tell its subjects.
SUBJECTS = {
    "criminal_law": ["penal", "criminal", "offence", "crime", "punishment", "imprisonment", "cognizable", "bail", "prosecution", "police"],
    "tax_law": ["tax", "duty", "excise", "customs", "income-tax", "gst", "goods and services", "stamp", "cess", "levy", "tariff", "revenue"],
    "property_law": ["property", "transfer", "easement", "mortgage", "tenancy", "rent", "land", "registration", "conveyance"],
    "labour_law": ["labour", "labor", "industrial", "workmen", "employment", "wage", "factory", "trade union", "provident fund", "gratuity"],
    "corporate_law": ["company", "companies", "corporate", "securities", "share", "debenture", "insolvency", "bankruptcy", "partnership", "llp"],
    "family_law": ["marriage", "divorce", "adoption", "maintenance", "guardians", "succession", "hindu", "muslim", "christian", "parsi"],
    "constitutional_law": ["constitution", "fundamental", "directive", "citizenship", "election", "parliament", "legislature"],
    "environmental_law": ["environment", "pollution", "forest", "wildlife", "water", "air", "conservation", "ecology", "biodiversity"],
    "banking_finance": ["banking", "bank", "reserve bank", "insurance", "financial", "negotiable instrument", "money", "credit", "loan"],
    "civil_procedure": ["civil procedure", "limitation", "arbitration", "evidence", "court fees", "suit", "decree", "appeal"],
    "administrative_law": ["tribunal", "commission", "authority", "board", "regulatory", "ombudsman", "administrative"],
    "intellectual_property": ["patent", "copyright", "trademark", "design", "geographical indication"],
    "information_technology": ["information technology", "cyber", "electronic", "digital", "data protection"],
}


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: Column | None = None, upper: Column | None = None) -> Column:
    """The value of the first rule (pattern, value) that the text matches; ``upper``, if given, spares most searches."""
    out = F.lit(None).cast("string") if default is None else default
    for pattern, value in reversed(list(rules)):
        out = F.when(matches(text, pattern, upper), value).otherwise(out)
    return out


def required(pattern: str) -> str | None:
    """The longest word that every match of a pattern without alternatives of its own holds, in upper case; null where none is sure."""
    plain = re.sub(r"\(\?[a-z]+\)", "", pattern)
    before = None
    while before != plain:  # groups go with what repeats them, from the inside
        before, plain = plain, re.sub(r"\((?:\?[:=!<]+)?[^()]*\)(?:[?*+]|\{[^}]*\})?", " ", plain)
    plain = re.sub(r"\[[^\]]*\](?:[?*+]|\{[^}]*\})?|\\.(?:[?*+]|\{[^}]*\})?", " ", plain)
    if "|" in plain or re.search(r"[()]", plain):
        return None
    words = re.findall(r"[A-Za-z]{2,}(?![?*A-Za-z])|[A-Za-z]{2,}(?=[A-Za-z][?*])", plain)
    return max(words, key=len).upper() if words else None


def matches(text: Column, pattern: str, upper: Column | None = None) -> Column:
    """Whether a text matches; where ``upper``, the text in upper case, is given, it must first hold the word that a match needs."""
    word = required(pattern) if upper is not None else None
    return text.rlike(pattern) if word is None else F.contains(upper, F.lit(word)) & text.rlike(pattern)


def _any(text: Column, phrases: Sequence[str]) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | text.contains(p)
    return found


def section_type(text: Column, lines: int = 15, chars: int = 1000) -> Column:
    """Type of a chunk: by the first heading in its first lines, else by phrases in its first characters, else body."""
    head = F.transform(F.slice(F.split(F.trim(text), "\n"), 1, lines), lambda x: F.upper(F.trim(x)))
    by_line = F.get(F.filter(F.transform(head, lambda x: first_match(x, SECTION_HEADINGS)), lambda t: t.isNotNull()), F.lit(0))
    start = F.upper(F.substring(text, 1, chars))
    by_phrase = F.lit("body")
    for kind, phrases in reversed(SECTION_PHRASES):
        by_phrase = F.when(_any(start, phrases), kind).otherwise(by_phrase)
    return F.coalesce(by_line, by_phrase, F.lit("body"))


def section_priority(kind: Column) -> Column:
    """From 30 for what isn't known to 100."""
    out = F.lit(30)
    for name, priority in SECTION_PRIORITIES.items():
        out = F.when(kind == name, priority).otherwise(out)
    return out


def is_important(kind: Column, least: int = 70) -> Column:
    return section_priority(kind) >= least


def _share(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(characters)) / F.length(text)


def _english_share(words: Column, edge: str) -> Column:
    """Share of frequent English words among ``words``, punctuation at their ends set aside."""
    known = F.array(*map(F.lit, ENGLISH_WORDS))
    hits = F.size(F.filter(words, lambda w: F.array_contains(known, F.regexp_replace(w, f"^[{edge}]+|[{edge}]+$", ""))))
    return F.try_divide(hits, F.size(words))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda w: w != "")


def language_class(text: Column) -> Column:
    """empty, mixed, hindi_unicode, english or gibberish, by the first 5000 characters."""
    sample = F.substring(text, 1, 5000)
    words = F.slice(_words(sample), 1, 200)
    english = _english_share(words, r".,;:()\"'")
    hindi = _share(sample, r"[ऀ-ॿ]")
    return (
        F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) < 100, "empty")
        .when((hindi > 0.15) & (_share(sample, r"[ -~]") > 0.3), "mixed")
        .when(hindi > 0.15, "hindi_unicode")
        .when(english > 0.08, "english")
        .when(_share(sample, r"[À-ɏ]") > 0.03, "gibberish")
        .when(english < 0.03, "gibberish")
        .otherwise("english")
    )


def body_class(text: Column) -> Column:
    """too_short, hindi_unicode, english or gibberish, by what follows the first 500 characters."""
    body = F.substring(text, 501, 3500)
    body = F.when(F.length(body) < 100, F.substring(text, 201, 1_000_000_000)).otherwise(body)
    short = (F.length(F.trim(F.coalesce(text, F.lit("")))) < 200) | (F.length(body) < 50) | (F.size(_words(body)) == 0)
    return (
        F.when(short, "too_short")
        .when(_share(body, r"[ऀ-ॿ]") > 0.15, "hindi_unicode")
        .when(_english_share(_words(body), r".,;:()\"'\-/*#\[\]{}") > 0.06, "english")
        .otherwise("gibberish")
    )


def legacy_font_class(text: Column) -> Column:
    """too_short, hindi_unicode, krutidev_gibberish or english."""
    body = F.when(F.length(text) > 500, F.substring(text, 301, 4700)).otherwise(text)
    hits = F.lit(0)
    for p in LEGACY_FONT:
        hits = hits + F.regexp_count(body, F.lit(p))
    legacy = (F.length(body) >= 100) & (F.try_divide(hits, F.size(_words(body))) > 0.05)
    return (
        F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) < 100, "too_short")
        .when(_share(F.substring(text, 1, 5000), r"[ऀ-ॿ]") > 0.10, "hindi_unicode")
        .when(F.coalesce(legacy, F.lit(False)), "krutidev_gibberish")
        .otherwise("english")
    )


def provision_type(text: Column) -> Column:
    """The legal nature of a provision by its modal verbs."""
    # Tried in this order.
    rules = [
        (r"\bnotwithstanding\s+anything\s+contained\s+in\b", "overriding"),
        (r"\bshall\s+not\b|\bno\s+person\s+shall\b|\bit\s+shall\s+be\s+unlawful\b", "prohibitory"),
        (r"\bshall\b", "mandatory"),
        (r"\bmay\b", "discretionary"),
        (r"\bis\s+deemed\s+to\b", "declaratory"),
    ]
    return first_match(F.lower(text), rules, F.lit("general"))


def legal_markers(text: Column) -> dict[str, Column]:
    """Flags of provisos, explanations, illustrations, overriding and saving clauses."""
    # The flags and their patterns.
    patterns = {
        "has_proviso": r"(?i)(?:^|\n)\s*Provided\s+that\b",
        "has_explanation": r"(?i)(?:^|\n)\s*Explanation\s*[.:\-—]",
        "has_illustration": r"(?i)(?:^|\n)\s*Illustration\s*[.:\-—]",
        "has_non_obstante": r"\b[Nn]otwithstanding\s+anything\s+(?:contained\s+in|inconsistent)",
        "has_saving_clause": r"\b[Nn]othing\s+in\s+this\s+(?:Act|section|Chapter)\s+shall\b",
    }
    return {k: text.rlike(p) for k, p in patterns.items()}


def section_status(text: Column) -> Column:
    """Whether a section is omitted, repealed, not yet in force, substituted or in force, by marks at its head."""
    # How far the marks may stand from the start, and the marks.
    stripped = F.trim(text)
    head = F.lower(F.substring(stripped, 1, 200))
    return (
        F.when(head.contains("[omitted") | F.substring(stripped, 1, 50).contains("* * *"), "omitted")
        .when(head.contains("[repealed"), "repealed")
        .when(head.contains("[not yet in force") | head.contains("[not yet enforced"), "not_yet_in_force")
        .when(head.contains("[substituted"), "substituted")
        .otherwise("in_force")
    )


def delegation_type(text: Column, section_number: Column) -> Column:
    """What power a section delegates: rules, regulations, notification, order or none (null); never the first section."""
    # Tried in this order.
    rules = [
        (r"\bmay\s*(?:,\s*by\s+notification[^,]*,\s*)?make\s+rules\b", "rules"),
        (r"\bmay\s*(?:,\s*by\s+notification[^,]*,\s*)?make\s+regulations\b", "regulations"),
        (r"\bmay,?\s+by\s+(?:official\s+)?notification[^.]*(?:appoint|direct|specify|exempt|declare|add|remove)\b", "notification"),
        (r"\bmay,?\s+by\s+order[^.]*(?:appoint|direct|specify|exempt|declare)\b", "order"),
    ]
    return F.when(F.coalesce(F.trim(section_number), F.lit("")) != "1", first_match(F.lower(text), rules))


def legal_subjects(*parts: Column) -> Column:
    """All subjects that words of a title, department or ministry tell; general if none."""
    text = F.lower(F.concat_ws(" ", *(F.coalesce(p, F.lit("")) for p in parts)))
    found = F.array_compact(F.array(*(F.when(_any(text, words), name) for name, words in SUBJECTS.items())))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("general")))


def document_class(text: Column) -> Column:
    """A sampled order's class by its length and headings."""
    # Headings and lengths.
    upper, n = F.upper(text), F.length(F.trim(F.coalesce(text, F.lit(""))))
    status = upper.contains("CASE INFORMATION") & (upper.contains("FILING NUMBER") | upper.contains("CURRENT STATUS"))
    return (
        F.when(n == 0, "no extractable text")
        .when(status, "case status sheet")
        .when(upper.contains("ORDER SHEET") & (n < 1500), "procedural order sheet")
        .when(n < 1200, "short procedural order")
        .when(n < 4000, "short order")
        .otherwise("substantive decision")
    )


# Older section types by words of a chunk's first line, tried in this order, and marks of legacy fonts in fonts' names.
OLDER_TYPES = [("JUDGMENT|ORDER", "judgment"), ("FACT|BACKGROUND", "facts"), ("CONCLUSION|HELD", "conclusion"), ("ISSUE|QUESTION", "issues")]
LEGACY_FONTS = ["Asees", "Akhar", "AnmolLipi"]


def older_section_type(text: Column) -> Column:
    """The type of a chunk by its first line that isn't blank, as older collections have it; body where that says nothing."""
    line = F.upper(F.regexp_extract(F.coalesce(text, F.lit("")), r"^\s*([^\n]*)", 1))
    return first_match(line, OLDER_TYPES, F.lit("body"))


def legacy_fonts(fonts: Column) -> Column:
    """The different names among ``fonts`` that mark a legacy font, sorted; empty without any."""
    marked = F.filter(fonts, lambda f: F.coalesce(_any(f, LEGACY_FONTS), F.lit(False)))
    return F.coalesce(F.array_sort(F.array_distinct(marked)), F.array().cast("array<string>"))
