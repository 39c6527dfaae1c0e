"""Redaction of identifying detail with per-rule counts, and exclusion of whole documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = "[REDACTED]"

# The published rules, in Java's dialect.
VICTIM_NAMED = (
    r"((?i:victim|prosecutrix)[,\s\w]{0,40}?\b(?i:namely|named|by name)\s*,?\s*)"
    r"((?:Smt\.?|Shri\.?|Mr\.?|Ms\.?|Dr\.?)?\s*[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2})"
)
CHILD_NAMED = (
    r"((?i:juvenile|CCL|child in conflict with (?:the )?law)[,\s]*\b(?i:namely|named|by name)\s*,?\s*)"
    r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2})"
)
PHONE = r"(?<!\d)(?:\+?91[\-\s]?)?[6-9]\d{9}(?!\d)"
EMAIL = r"\b[\w.+-]+@[\w-]+\.[\w.]{2,}\b"
PAN = r"\b[A-Z]{5}[0-9]{4}[A-Z]\b"
IFSC = r"\b[A-Z]{4}0[A-Z0-9]{6}\b"
AADHAAR = r"(?<!\d)\d{4}\s?\d{4}\s?\d{4}(?!\d)"
PAN_CONTEXT = ["PAN", "permanent account number"]
IFSC_CONTEXT = ["IFSC", "NEFT", "RTGS", "branch code", "account no", "account number"]
AADHAAR_CONTEXT = ["aadhaar", "aadhar", "UIDAI", "unique identification"]
CONTEXT_WINDOW = 80
NON_PUBLICATION = (
    r"(?i)(?<!not )(?<!never )(?<!was not )(?<!were not )\bin\s?-?\s?camera\b(?![^.]{0,40}\bnot\b)"
    r"|shall not be (?:published|reported|disclosed)"
    r"|not (?:be )?(?:published|reported) in any (?:manner|form|media)"
    r"|identity of the (?:victim|child|prosecutrix) shall not"
)
FURNITURE = (
    r"(?im)Indian\s+Kanoon\s*-\s*https?://indiankanoon\.org/doc/\d+"
    r"|https?://(?:www\.)?indiankanoon\.org/doc/\d+/\d+\s*$"
    r"|\bCite\s+this\s+(?:article|document)\b"
    r"|\bTry\s+out\s+our\s+Premium\s+Member\b"
)
RULES = ["victim_relative_named", "protected_child_named", "phone", "email", "pan", "ifsc", "aadhaar"]

#: The permutation whose powers Verhoeff's check applies to the digits.
_TURN = [1, 5, 7, 6, 2, 8, 3, 0, 9, 4]


def _powers() -> list[int]:
    """The first eight powers of the permutation, one after the other."""
    out, now = [], list(range(10))
    for _ in range(8):
        out += now
        now = [_TURN[x] for x in now]
    return out


def _symmetries() -> list[int]:
    """Products of the ten symmetries of a pentagon: rotations 0 to 4, reflections 5 to 9."""

    def times(a: int, b: int) -> int:
        sign = -1 if a > 4 else 1
        return (a % 5 + sign * (b % 5)) % 5 + 5 * ((a > 4) != (b > 4))

    return [times(a, b) for a in range(10) for b in range(10)]


def check_digit_holds(number: Column) -> Column:
    """Whether a text's digits are twelve and satisfy Verhoeff's check."""
    digits = F.regexp_replace(number, r"\D", "")
    powers, products = F.array(*map(F.lit, _powers())), F.array(*map(F.lit, _symmetries()))
    places = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.get(powers, (i % 8) * 10 + d.cast("int")))
    check = F.aggregate(places, F.lit(0), lambda a, p: F.get(products, a * 10 + p))
    return F.when(F.length(digits) == 12, check == 0).otherwise(False)


def _near(pattern: str, words: list[str]) -> str:
    """``pattern`` where one of the words stands, as a word, within the window before or after it."""
    around = [f"(?<=\\b{w}\\b[\\s\\S]{{0,{CONTEXT_WINDOW - len(w)}}})" for w in words]
    ahead = [f"(?=[\\s\\S]{{0,{CONTEXT_WINDOW - len(w)}}}\\b{w}\\b)" for w in words]
    # what must be masked is looked for first: the window is only searched around it
    return f"(?={pattern})(?:(?i:{'|'.join(around)}){pattern}|{pattern}(?i:{'|'.join(ahead)}))"


def _masked(text: Column, pattern: str, valid: Callable[[Column], Column]) -> tuple[Column, Column]:
    """Text with the pattern's valid matches masked, and how many were."""
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    masked = F.transform(found, lambda m: F.when(valid(m), MASK).otherwise(m))
    joined = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(masked, i), F.lit("")))), "")
    return joined, F.size(F.filter(found, valid))


#: What each rule but the last looks for, and puts in its place.
PATTERNS = {
    "victim_relative_named": (VICTIM_NAMED, "$1" + MASK),
    "protected_child_named": (CHILD_NAMED, "$1" + MASK),
    "phone": (PHONE, MASK),
    "email": (EMAIL, MASK),
    "pan": (_near(PAN, PAN_CONTEXT), MASK),
    "ifsc": (_near(IFSC, IFSC_CONTEXT), MASK),
}


#: What a text must have for a rule to be worth its search: words, whatever their case, or a pattern that is found faster.
WORDS = {"victim_relative_named": ["victim", "prosecutrix"], "protected_child_named": ["juvenile", "ccl", "child in conflict with"], "email": ["@"]}
PLAIN = {"phone": r"[6-9]\d{9}", "pan": r"[A-Z]{5}[0-9]{4}[A-Z]", "ifsc": r"[A-Z]{4}0[A-Z0-9]{6}", "aadhaar": r"\d{4}\s?\d{4}\s?\d{4}"}


def _worth(text: Column, rule: str) -> Column:
    if rule in PLAIN:
        return text.rlike(PLAIN[rule])
    lower, found = F.lower(text), F.lit(False)
    for word in WORDS[rule]:
        found = found | F.contains(lower, F.lit(word))
    return found


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _step(state: Column, done: list[str], rule: str) -> Column:
    """``state``, a struct of the text and the counts so far, after one more rule; matches are only counted where the text changed."""

    def counted(before: Column, after: Column, count: Column) -> Column:
        hits = F.when(after.eqNullSafe(before["text"]), 0).otherwise(count)
        return F.struct(after.alias("text"), *(before[r].alias(r) for r in done), hits.alias(rule))

    def apply(before: Column) -> Column:
        if rule == "aadhaar":
            after, count = _masked(before["text"], _near(AADHAAR, AADHAAR_CONTEXT), check_digit_holds)
        else:
            pattern, replacement = PATTERNS[rule]
            after, count = F.regexp_replace(before["text"], pattern, replacement), F.regexp_count(before["text"], F.lit(pattern))
        after = F.when(_worth(before["text"], rule), after).otherwise(before["text"])
        return _let(after, lambda after: counted(before, after, count))

    return _let(state, apply)


def redact(text: Column) -> Column:
    """A struct of the masked text and ``counts``, a map of the rules that hit; null stays null, without counts.

    Rules follow each other, each on what the last one left.
    """
    state = F.struct(text.alias("text"))
    for k, rule in enumerate(RULES):
        state = _step(state, RULES[:k], rule)

    def result(s: Column) -> Column:
        entries = F.array(*(F.struct(F.lit(k).alias("key"), s[k].alias("value")) for k in RULES))
        return F.struct(s["text"].alias("text"), F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0)).alias("counts"))

    return _let(state, result)


def has_furniture(text: Column) -> Column:
    """Whether a third party's page furniture is in the text."""
    return F.coalesce(text, F.lit("")).rlike(FURNITURE)


def excluded(text: Column) -> Column:
    """Whether the document must go rather than be redacted."""
    return F.coalesce(text, F.lit("")).rlike(NON_PUBLICATION) | has_furniture(text)
