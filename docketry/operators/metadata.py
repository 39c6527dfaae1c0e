"""Metadata of cases from several sources: per field an order of sources, what is valid, and a note of which source won."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract, naming


def filled(value: Column, kind: str) -> Column:
    """Whether a value says anything: no null, empty text or list, or zero."""
    if kind.startswith("array"):
        return F.coalesce(F.size(value) > 0, F.lit(False))
    if kind == "string":
        return F.coalesce(F.trim(value) != "", F.lit(False))
    return value.isNotNull() & (value != 0) if kind in ("int", "bigint", "double", "smallint") else value.isNotNull()


@dataclass(frozen=True)
class Rule:
    """A field, the sources and their columns in the order that they count, and what a value must satisfy besides being there."""

    field: str
    sources: Sequence[tuple[str, str]]
    valid: Callable[[Column], Column] = field(default=lambda value: F.lit(True))


# Which source counts before which, by field; the registry first but for parties and judges.
CASE_RULES = [
    Rule("title", [("registry", "title"), ("text", "heading")]),
    Rule("description", [("registry", "description"), ("text", "description")]),
    Rule("court", [("registry", "court"), ("text", "court")]),
    Rule("decision_date", [("registry", "decision_date"), ("text", "decision_date")]),
    Rule("date_of_registration", [("registry", "date_of_registration"), ("text", "date_of_registration")]),
    Rule("judges", [("text", "judges"), ("registry", "judges")]),
    Rule("petitioner", [("text", "petitioner"), ("title", "petitioner")]),
    Rule("respondent", [("text", "respondent"), ("title", "respondent")]),
    Rule("disposition", [("registry", "disposal_nature"), ("text", "disposal_status")]),
    Rule("case_type", [("text", "case_type")]),
    Rule("case_number", [("text", "case_number")]),
]


def merged(cases: DataFrame, sources: dict[str, DataFrame], rules: Sequence[Rule], key: str) -> DataFrame:
    """``cases`` (key) with each rule's field, from the first of its sources that has a valid value, and ``won``, a map of which that was.

    A source has a row per key (of several, one is taken); keys, sources and columns
    that aren't there leave a field to the next source, and null where none has it.
    """
    out = cases.select(key).distinct()
    kinds: dict[str, dict[str, str]] = {}
    for name, source in sources.items():
        kinds[name] = dict(source.dtypes)
        rest = [c for c in source.columns if c != key]
        one = source.groupBy(key).agg(F.max(F.struct(*rest)).alias(f"_{name}")) if rest else source.select(key).distinct()
        out = out.join(one, key, "left")

    def candidates(rule: Rule) -> list[tuple[str, Column, Column]]:
        found = []
        for source, column in rule.sources:
            if column in kinds.get(source, {}):
                value = F.col(f"_{source}")[column]
                found.append((source, value, filled(value, kinds[source][column]) & F.coalesce(rule.valid(value), F.lit(False))))
        return found

    fields, won = [], []
    for rule in rules:
        choice = candidates(rule)
        value, source = F.lit(None), F.lit(None).cast("string")
        for name, candidate, ok in reversed(choice):
            value, source = F.when(ok, candidate).otherwise(value), F.when(ok, name).otherwise(source)
        fields.append((value if choice else F.lit(None).cast("string")).alias(rule.field))
        won.append(F.struct(F.lit(rule.field).alias("key"), source.alias("value")))
    notes = F.map_from_entries(F.filter(F.array(*won), lambda e: e["value"].isNotNull()))
    return out.select(key, *fields, notes.alias("won"))


# What parts the parties of a registry's title, and its judges.
TITLE_PARTIES, JUDGE_SEPARATORS = r"(.+?)\s+[Vv]s\.?\s+(.+)", "[,&]"


def from_title(title: Column) -> Column:
    """A struct (petitioner, respondent) of the sides of a registry's title, empty without two."""
    return F.struct(*(F.trim(F.regexp_extract(F.coalesce(title, F.lit("")), TITLE_PARTIES, g)).alias(n) for g, n in ((1, "petitioner"), (2, "respondent"))))


def registry_rows(registry: DataFrame, files: DataFrame, benches: dict[str, str], key: str = "cnr") -> DataFrame:
    """High-court registry rows with what the files' paths say (``files``: key, year, bench, court_code, pdf_url) as chunk metadata.

    A year is the first four digits of the decision's date, or the path's.  Rows
    without a file keep empty texts and no year.
    """
    rows = registry.join(files.withColumnRenamed("year", "_year"), key, "left")
    sides, date = from_title(F.col("title")), F.coalesce(F.col("decision_date").cast("string"), F.lit(""))
    code = naming.court_code(F.col("court_code"))
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in ("title", "date_of_registration", "description", "disposal_nature", "pdf_url", "bench", "court_code")}
    return rows.select(
        F.col(key).alias("case_id"), text["title"].alias("title"), F.lit("").alias("citation"), F.col(key).alias("case_number"),
        F.coalesce(F.nullif(F.regexp_extract(date, r"(\d{4})", 1), F.lit("")).cast("int"), F.col("_year").cast("int"), F.lit(0)).alias("year"), date.alias("decision_date"), text["date_of_registration"].alias("date_of_registration"),
        F.coalesce("court", F.lit("High Court")).alias("court"), text["court_code"].alias("court_code"), *(code[c].alias(c) for c in ("state_code", "establishment_code", "state_name")), text["bench"].alias("bench"),
        naming.bench_name(text["bench"], benches).alias("bench_display_name"), sides["petitioner"].alias("petitioner"), sides["respondent"].alias("respondent"),
        F.filter(F.transform(F.split(F.coalesce("judge", F.lit("")), JUDGE_SEPARATORS), lambda j: F.trim(j)), lambda j: j != "").alias("judges"),
        text["disposal_nature"].alias("disposition"), text["description"].alias("description"), text["pdf_url"].alias("pdf_url"),
    )


# Characters of a snippet, and dispositions of exports by how they are written.
SNIPPET = 200
EXPORTED_DISPOSITIONS = {
    "Allowed": "ALLOWED", "ALLOWED": "ALLOWED", "allowed": "ALLOWED", "Dismissed": "DISMISSED", "DISMISSED": "DISMISSED", "dismissed": "DISMISSED", "Disposed Off": "DISPOSED OF", "DISPOSED OFF": "DISPOSED OF",
    "DISPOSED": "DISPOSED OF", "Disposed Of": "DISPOSED OF", "Disposed": "DISPOSED OF", "DISPOSED OF": "DISPOSED OF", "Partly Allowed": "PARTLY ALLOWED", "PARTLY ALLOWED": "PARTLY ALLOWED", "Rejected": "REJECTED",
    "REJECTED": "REJECTED", "Bail": "BAIL GRANTED", "BAIL": "BAIL GRANTED", "Bail Granted": "BAIL GRANTED",
}


def case_rows(payloads: DataFrame) -> DataFrame:
    """First chunks as rows of cases: primary citation, day-first dates turned round, bench strength by judges, a snippet; rows without a case go."""
    court = naming.court_label(F.col("court"))
    day = F.substring_index(F.col("decision_date").cast("string"), " ", 1)
    turned = F.when(day.rlike(r"^[^-]*-[^-]*-[^-]{4}$"), F.concat_ws("-", F.substring_index(day, "-", -1), F.element_at(F.split(day, "-"), 2), F.substring_index(day, "-", 1))).otherwise(day)
    citation = F.coalesce(extract.nonempty(F.col("citation")), F.concat(F.lit("HC-"), "case_id"))
    strength = F.coalesce(F.when(F.col("bench_strength") > 0, F.col("bench_strength")), F.nullif(F.size("judges"), F.lit(0)))
    dispositions = F.create_map(*(F.lit(x) for pair in EXPORTED_DISPOSITIONS.items() for x in pair))
    parts = F.concat_ws(" | ", *(extract.nonempty(F.col(c)) for c in ("title", "petitioner", "respondent")))
    kind = F.coalesce(extract.nonempty(F.col("court_type")), F.when(court.contains("Supreme"), "supreme_court").when(court != "", "high_court"))
    return payloads.filter(F.coalesce(F.col("case_id") != "", F.lit(False))).select(
        F.col("case_id").alias("corpus_case_id"), F.col("title").alias("case_name"), "court", kind.alias("court_type"), court.alias("court_normalized"), "year", citation.alias("primary_citation"),
        F.nullif(turned, F.lit("")).alias("decision_date"), "disposition", F.try_element_at(dispositions, F.col("disposition")).alias("disposition_normalized"), "petitioner", "respondent",
        F.when(strength > 0, strength).cast("int").alias("bench_strength"), F.when(F.size("judges") > 0, F.to_json("judges")).alias("judges"), F.nullif(F.trim(F.substring(parts, 1, SNIPPET)), F.lit("")).alias("snippet"),
    )
