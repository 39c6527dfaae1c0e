"""Names of courts, benches, issuers and folders, from codes and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of high courts and the names they stand for; "High Court" alone is nobody's.
COURT_NAMES = {
    "High Court of Allahabad": "Allahabad High Court",
    "High Court of Andhra Pradesh": "Andhra Pradesh High Court",
    "High Court of Amaravati": "Andhra Pradesh High Court",
    "High Court of Bombay": "Bombay High Court",
    "High Court of Calcutta": "Calcutta High Court",
    "High Court Of Chhattisgarh": "Chhattisgarh High Court",
    "High Court of Chhattisgarh": "Chhattisgarh High Court",
    "High Court of Delhi": "Delhi High Court",
    "High Court of Gauhati": "Gauhati High Court",
    "High Court of Gujarat": "Gujarat High Court",
    "High Court of Himachal Pradesh": "Himachal Pradesh High Court",
    "High Court of Jammu and Kashmir": "Jammu & Kashmir High Court",
    "High Court of Jharkhand": "Jharkhand High Court",
    "High Court of Karnataka": "Karnataka High Court",
    "High Court of Kerala": "Kerala High Court",
    "High Court of Madhya Pradesh": "Madhya Pradesh High Court",
    "High Court of Madras": "Madras High Court",
    "High Court of Manipur": "Manipur High Court",
    "High Court of Meghalaya": "Meghalaya High Court",
    "High Court of Orissa": "Orissa High Court",
    "High Court of Patna": "Patna High Court",
    "High Court of Punjab and Haryana": "Punjab and Haryana High Court",
    "High Court of Haryana": "Punjab and Haryana High Court",
    "High Court Of Rajasthan": "Rajasthan High Court",
    "High Court of Rajasthan": "Rajasthan High Court",
    "High Court of Sikkim": "Sikkim High Court",
    "High Court  for State of Telangana": "Telangana High Court",
    "High Court of Telangana": "Telangana High Court",
    "High Court of Hyderabad": "Telangana High Court",
    "High Court of Tripura": "Tripura High Court",
    "High Court of Uttarakhand": "Uttarakhand High Court",
    "High Court of Mumbai": "Bombay High Court",
    "High Court of Nagpur": "Bombay High Court",
    "High Court of Aurangabad": "Bombay High Court",
    "High Court of Jabalpur": "Madhya Pradesh High Court",
    "High Court of Chennai": "Madras High Court",
    "High Court of Andhra": "Andhra Pradesh High Court",
    "High Court of Guwahati": "Gauhati High Court",
    "High Court of Kashmir": "Jammu & Kashmir High Court",
    "High Court of Chandigarh": "Punjab and Haryana High Court",
}
UNRESOLVED_COURT = "(unresolved court label)"
# States by the first part of a court code.
STATES = {
    "1": "Jammu & Kashmir",
    "2": "Tripura",
    "3": "Himachal Pradesh",
    "4": "Uttarakhand",
    "5": "Andhra Pradesh",
    "7": "Delhi",
    "8": "Rajasthan",
    "9": "Uttar Pradesh",
    "10": "Bihar",
    "11": "Sikkim",
    "14": "Manipur",
    "16": "Telangana",
    "17": "Meghalaya",
    "18": "Assam",
    "19": "West Bengal",
    "20": "Jharkhand",
    "21": "Odisha",
    "22": "Chhattisgarh",
    "23": "Madhya Pradesh",
    "24": "Gujarat",
    "25": "Rajasthan",
    "26": "Punjab & Haryana",
    "27": "Maharashtra",
    "28": "Delhi",
    "29": "Uttar Pradesh",
    "30": "Karnataka",
    "31": "Kerala",
    "32": "Tamil Nadu",
    "33": "Tamil Nadu",
    "36": "Andhra Pradesh",
}
# Courts that a bench's slug may begin with, and kinds of issuers.
BENCH_COURTS = ["calcutta", "bombay", "delhi", "madras", "chennai", "karnataka", "allahabad", "gujarat", "kerala", "punjab"]
ISSUER_KINDS = {
    "central": ("CENTRAL", "Central Act"),
    "state": ("STATE", "State or UT legislation"),
    "REP": ("REPEALED", "repealed Act"),
    "SPENT": ("SPENT", "spent Act"),
}


def named(raw: Column, names: dict[str, str]) -> Column:
    """The name that stands for a value; null for others."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), raw)


def court_label(raw: Column) -> Column:
    """A high court's one name; labels that aren't listed stay as they are."""
    return F.coalesce(named(raw, COURT_NAMES), F.when(raw == "High Court", UNRESOLVED_COURT), raw)


def is_supreme_id(case_id: Column) -> Column:
    """Whether an id has the Supreme Court's shape: four digits and an underscore."""
    return F.coalesce(case_id.rlike(r"^\d{4}_"), F.lit(False))


def act_status(category: Column) -> Column:
    lower = F.lower(F.coalesce(category, F.lit("")))
    return F.when(lower.isin("repealed", "spent"), lower).otherwise("in_force")


def issuer(act_id: Column) -> Column:
    """A struct of the code and kind of who issued an act, by its id."""
    second = F.coalesce(F.get(F.split(act_id, "_"), F.lit(1)), F.lit(""))

    def of(code: Column | str, kind: str) -> Column:
        return F.struct((F.lit(code) if isinstance(code, str) else code).alias("issuer"), F.lit(kind).alias("kind"))

    out = of("OTHER", "other")
    for part, (code, kind) in ISSUER_KINDS.items():
        out = F.when(act_id.startswith("IND_") & (second == part), of(code, kind)).otherwise(out)
    return F.when(act_id.startswith("REG_"), of(second, "regulator instrument")).otherwise(out)


def folder(key: Column) -> Column:
    """The folder of an object's key that says which part of a collection it is of."""
    parts = F.split(key, "/")
    deep = F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 1, 2), "/")).otherwise(F.get(parts, F.lit(0)))
    return F.when(F.size(parts) <= 1, "(root)").when(F.get(parts, F.lit(0)).startswith("IND_"), "(per-act folders)").otherwise(deep)


def extension(key: Column) -> Column:
    found = F.lower(F.regexp_extract(key, r"\.([A-Za-z0-9]{1,6})$", 1))
    return F.when(found == "", "(no extension)").otherwise(found)


def court_code(code: Column) -> Column:
    """A struct of a court code's state, establishment and state name; empty for codes without an underscore."""
    whole = F.coalesce(F.contains(code, F.lit("_")), F.lit(False))
    parts = F.split(code, "_", 2)
    state = F.get(parts, F.lit(0))
    values = {"state_code": state, "establishment_code": F.get(parts, F.lit(1)), "state_name": F.coalesce(named(state, STATES), F.concat(F.lit("State "), state))}
    return F.struct(*(F.when(whole, v).otherwise("").alias(k) for k, v in values.items()))


def bench_name(slug: Column, names: dict[str, str] | None = None) -> Column:
    """A bench's name: the listed one, or a readable slug's words without the court, or the slug as it is."""
    parts = F.split(slug, "_")
    rest = F.when(F.lower(F.get(parts, F.lit(0))).isin(BENCH_COURTS), F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts)
    words = F.array_join(F.transform(rest, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))), " ")
    readable = F.contains(slug, F.lit("_")) & ~F.contains(F.lower(slug), F.lit("ucisdb"))
    listed = named(slug, names) if names else F.lit(None).cast("string")
    return F.coalesce(listed, F.when(readable, words).otherwise(F.concat(F.lit("Bench ("), slug, F.lit(")"))))


def month_slice(date: Column) -> Column:
    """A struct of the first day of a date's month and of the next month: the range [lo, hi)."""
    lo = F.trunc(date, "month")
    return F.struct(lo.alias("lo"), F.add_months(lo, 1).alias("hi"))


def section_class(number: Column, title: Column, html: bool = False) -> Column:
    """What a section of an act is, by its number and title; labels of HTML sections also tell schedules and preambles."""
    lower = F.lower(F.coalesce(title, F.lit("")))
    out = F.when((number == "1") & (lower.contains("short title") | lower.contains("extent")), "short_title").when(lower.contains("definition") | lower.contains("interpretation"), "definitions")
    if html:
        return out.when(lower.contains("schedule"), "schedule").when(lower.contains("preamble"), "preamble").otherwise("section")
    return out.when(lower.contains("amendment") & lower.contains("act"), "amendment_provision").otherwise("section")


def is_roman(number: Column) -> Column:
    """Whether a text of at most six letters I, V, X, L, C, D and M adds up to 1 to 100."""
    worth = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
    values = F.transform(F.split(number, ""), lambda c: F.coalesce(*(F.when(c == k, v) for k, v in worth.items()), F.lit(0)))
    signed = F.transform(values, lambda v, i: F.when(v < F.coalesce(F.get(values, i + 1), F.lit(0)), -v).otherwise(v))
    total = F.aggregate(signed, F.lit(0), lambda a, x: a + x)
    return F.coalesce(number.rlike("^[IVXLCDM]{1,6}$") & total.between(1, 100), F.lit(False))


def corruption_class(ratio: Column, average: Column, least_ratio: float = 0.5, least_score: float = 0.5) -> Column:
    return F.when((ratio >= least_ratio) & (average >= least_score), "DEFINITE").when((ratio >= 0.3) & (average >= 0.4), "PARTIAL").otherwise("BORDERLINE")
