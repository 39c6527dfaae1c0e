"""Records of tribunals, each with fields of its own, on one schema.

A tribunal is described by a ``Tribunal``: which raw field each common field comes from, which raw
fields are kept as columns, and what makes a record a judgment.  A line of JSON is read as a map
of Variants, so that numbers, lists and objects stay what they are; fields that
nothing takes are kept under ``raw_metadata``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract
from ..functions.redaction import _let
from ..functions.text import bench_slug, clean_field


@dataclass(frozen=True)
class Tribunal:
    slug: str
    name: str
    bench_prefix: str
    fields: dict[str, str] = field(default_factory=dict)  # common field: raw field; a common field that isn't named has its own name
    extra: tuple[str, ...] = ()
    court_type: str = "tribunal"
    judgment: tuple[str, str, str] | None = None  # rule, raw field or _path, value

    def raw(self, common: str) -> str:
        return self.fields.get(common, common)


# Common fields in their order, without the extra ones of a tribunal.
COMMON = (
    "case_id case_number court court_type bench bench_strength country_code state_code state_name language_code decision_date year disposition case_type petitioner respondent judges title description "
    "acts_referenced cases_cited cited_by_count pdf_url source_pdf_url source_url tribunal raw_metadata scraped_at source_file is_judgment"
).split()
# Raw fields that are taken by name, whatever the tribunal.
TAKEN = "scraped_at source_url country country_code tribunal search_result case_title1 case_title2 case_no disposal_date date_of_filing".split()
# Fields of nested search results that stand in for absent ones; the rest gets a prefix.
PROMOTED = {
    "case_no": "case_no", "case_title1": "case_title1", "case_title2": "case_title2", "case_type_desc_cis": "case_type_desc", "date_of_filing": "date_of_filing", "disposal_date": "disposal_date", "action_type": "action_type",
    "status": "case_status", "bench_location_name": "bench_location",
}
# Where files that were fetched lie, by tribunal: the raw field that must be there, and the path of raw fields,
# in lower case and with what stands for an absent one where the path says so; file is the name of the source file, less its suffixes.
LOCAL = {
    "sat": ("pdf_filename", "local://sat/pdfs/{appeal_type|lower}/{pdf_filename}"),
    "aptel": ("pdf_filenames", "local://aptel/pdfs/{year|unknown}/{pdf_filenames}"),
    "cci": ("pdf_filenames", "local://cci/pdfs/{category|unknown}/{pdf_filenames}"),
    "cestat": ("pdf_id", "local://cestat/orders/{bench|lower|unknown}/{pdf_id}.pdf"),
    "rera_punjab": ("pdf_filename", "local://rera-punjab/pdfs/{pdf_filename}"),
    "itat": ("pdf_filename", "local://itat/pdfs/{pdf_filename}"),
    "cat": ("pdf_filename", "local://cat/pdfs/{bench_slug|unknown}/{pdf_filename}"),
    "ngt": ("pdf_filename", "local://ngt/pdfs/{bench|lower|unknown}/{pdf_filename}"),
    "atfp": ("pdf_filename", "local://atfp/pdfs/{pdf_filename}"),
    "gst_aar": ("pdf_filename", "local://gst-aar/pdfs/{ruling_type|lower|aar}/{pdf_filename}"),
    "ibbi": ("pdf_filename", "local://ibbi/pdfs/{file|-orders|ibbi}/{pdf_filename}"),
    "tdsat": ("filename", "local://tdsat/judgments/{filename}"),
    "rera_delhi": ("pdf_filename", "local://rera-delhi/pdfs/{pdf_filename}"),
    "drt": ("pdf_filename", "local://drt/pdfs/{pdf_filename}"),
    "nclt": ("case_no", "local://nclt/pdfs/{file|-cases|unknown}/{case_no}.pdf"),
}
FALLBACK = "local://rera-maharera/pdfs/{pdf_filename}"
#: Tribunals whose case numbers recur from bench to bench and year to year.
WITH_CONTEXT = ("cat", "cat_cis")

_FALSE = ["null", "false", "0", "0.0", '""', "[]", "{}"]


def parsed(lines: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """Lines that hold a JSON object, with ``record``, a map of Variants; and those that don't, but blank ones."""
    rows = lines.filter(F.trim(line) != "").withColumn("record", F.from_json(line, "map<string,variant>"))
    return rows.filter("record is not null"), rows.filter("record is null").drop("record")


def _text(record: Column, name: str) -> Column:
    """A raw field as text, numbers and objects as JSON writes them; null where it is absent or null."""
    return F.try_variant_get(F.try_element_at(record, F.lit(name)), "$", "string")


def _list(record: Column, name: str) -> Column:
    """A raw field that is a list, as texts; null where it is none."""
    return F.try_variant_get(F.try_element_at(record, F.lit(name)), "$", "array<string>")


def _true(record: Column, name: str) -> Column:
    """Whether a raw field is there and is not empty, zero or false."""
    return F.coalesce(~F.to_json(F.try_element_at(record, F.lit(name))).isin(_FALSE), F.lit(False))


def flattened(record: Column, name: str = "search_result") -> Column:
    """A record whose nested object ``name`` is put beside its other fields: promoted where these are absent, and all of it under ``sr_``."""

    def merge(parts: Column) -> Column:
        inner, own = parts["inner"], parts["own"]
        names = F.create_map(*(F.lit(x) for pair in PROMOTED.items() for x in pair))
        promoted = F.transform_keys(F.map_filter(inner, lambda k, _: names[k].isNotNull() & ~F.map_contains_key(own, names[k])), lambda k, _: names[k])
        prefixed = F.transform_keys(F.map_filter(inner, lambda k, _: ~F.map_contains_key(own, F.concat(F.lit("sr_"), k))), lambda k, _: F.concat(F.lit("sr_"), k))
        return F.map_concat(own, promoted, prefixed)

    inner = F.from_json(F.to_json(F.try_element_at(record, F.lit(name))), "map<string,variant>")
    is_object = F.startswith(F.to_json(F.try_element_at(record, F.lit(name))), F.lit("{"))
    parts = F.struct(inner.alias("inner"), F.map_filter(record, lambda k, _: k != name).alias("own"))
    return F.when(is_object, _let(parts, merge)).otherwise(record)


def _path(record: Column, source: Column, template: str) -> Column:
    """A local path by its template."""
    parts = []
    for text, names in re.findall(r"([^{]+)|\{([^}]+)\}", template):
        if text:
            parts.append(F.lit(text))
            continue
        name, *options = names.split("|")
        if name == "file":
            suffix, otherwise = options
            stem = F.regexp_replace(F.regexp_extract(F.coalesce(source, F.lit("")), r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
            parts.append(F.coalesce(F.nullif(F.replace(F.replace(stem, F.lit(suffix), F.lit("")), F.lit(".jsonl"), F.lit("")), F.lit("")), F.lit(otherwise)))
            continue
        value = F.get(_list(record, name), F.lit(0)) if name.endswith("filenames") else _text(record, name)
        if name == "case_no":
            value = F.replace(value, F.lit("/"), F.lit("_"))
        otherwise = next((o for o in options if o != "lower"), "")
        value = F.coalesce(F.nullif(value, F.lit("")), F.lit(otherwise))
        parts.append(F.lower(value) if "lower" in options else value)
    return F.concat(*parts)


def is_judgment(record: Column, source: Column, rule: tuple[str, str, str] | None) -> Column:
    """always_true, not_empty, equals, contains (in any case), or contains on ``_path``: any of a comma list in the source file's path."""
    if rule is None:
        return F.lit(False)
    kind, name, value = rule
    text = F.lower(F.coalesce(_text(record, name), F.lit("")))
    if kind == "always_true":
        return F.lit(True)
    if kind == "not_empty":
        return _true(record, name)
    if kind == "equals":
        return text == value.lower()
    if kind == "contains" and name == "_path":
        return reduce(lambda a, b: a | b, (F.contains(F.coalesce(source, F.lit("")), F.lit(v.strip())) for v in value.split(",")))
    if kind == "contains":
        return F.contains(text, F.lit(value.lower()))
    raise ValueError(f"unknown rule: {kind}")


def normalized(records: DataFrame, tribunal: Tribunal, source: str = "source_file") -> DataFrame:
    """``records`` (record, source file) of one tribunal on the common schema, then its extra fields as texts; records without a file are dropped.

    Fields that are null or absent give null, names an empty text; what no rule and no
    extra field takes is kept in ``raw_metadata``, as a map of Variants.
    """
    slug = tribunal.slug
    rows = records.withColumn("_r", flattened(F.col("record")) if slug == "nclt" else F.col("record"))
    r, path = F.col("_r"), F.col(source)

    def raw(common: str) -> Column:
        return _text(r, tribunal.raw(common))

    # no value for what follows without a file, or the name of one
    rows = rows.filter(_true(r, tribunal.raw("pdf_url")) | _true(r, "has_pdf") | _true(r, "pdf_filename"))

    petitioner, respondent, number, date = clean_field(raw("petitioner")), clean_field(raw("respondent")), raw("case_number"), raw("decision_date")
    cities: dict[str, Column] = {}
    if slug == "itat":
        parts = {"petitioner": extract.party_and_city(petitioner), "respondent": extract.party_and_city(respondent)}
        petitioner, respondent = (parts[k]["party"] for k in parts)
        cities = {f"{k}_city": F.nullif(v["city"], F.lit("")) for k, v in parts.items()}
    if slug == "aptel":
        both = extract.parties(raw("title"))
        named = petitioner != ""
        petitioner, respondent = (F.when(named | raw("title").isNull(), own).otherwise(both[k]) for k, own in (("petitioner", petitioner), ("respondent", respondent)))
    if slug == "nclt":
        petitioner, respondent = (F.coalesce(F.nullif(own, F.lit("")), clean_field(_text(r, k))) for own, k in ((petitioner, "case_title1"), (respondent, "case_title2")))
        number = extract.first_nonempty(number, _text(r, "case_no"))
        date = extract.first_nonempty(date, _text(r, "disposal_date"), _text(r, "date_of_filing"))
    if slug == "gst_aar":
        date = extract.first_nonempty(date, _text(r, "order_no_date"))

    rows = rows.withColumns({"_petitioner": petitioner, "_respondent": respondent, "_number": number, "_date": extract.parse_date(date)})
    year = extract.year_of(F.col("_date"), extract.first_nonempty(_text(r, "case_year"), _text(r, "year")))
    url = F.coalesce(F.get(_list(r, tribunal.raw("pdf_url")), F.lit(0)), F.when(_list(r, tribunal.raw("pdf_url")).isNull(), F.nullif(raw("pdf_url"), F.lit(""))))
    url = F.coalesce(F.nullif(url, F.lit("")), F.when(_true(r, "has_pdf") & _true(r, "pdf_filename"), _path(r, path, FALLBACK)))
    local = F.lit(None).cast("string")
    if slug in LOCAL:
        needs, template = LOCAL[slug]
        local = F.when(_true(r, needs), _path(r, path, template))
        if slug == "aptel":  # its files lie by the year of the record, which then counts
            year = F.when(local.isNotNull(), _text(r, "year").try_cast("int")).otherwise(year)
    rows = rows.withColumns({"_year": year, "_url": url, "_local": local, "_bench": bench_slug(tribunal.bench_prefix, raw("bench"))})

    judges = _list(r, tribunal.raw("judges"))
    listed = F.filter(F.transform(judges, clean_field), lambda x: x != "")
    fallback = {"petitioner": F.col("_petitioner"), "date": F.col("_date"), "bench": F.col("_bench")}
    context = slug in WITH_CONTEXT
    if context:
        fallback |= {"case_type": F.nullif(raw("case_type"), F.lit("")), "year": F.col("_year")}
    country = F.trim(_text(r, "country"))
    code = F.when(F.lower(country).isin("in", "india"), "IN").when(F.length(country) == 2, F.upper(country))
    title = F.coalesce(F.when(_true(r, tribunal.raw("title")), clean_field(raw("title"))), extract.case_title(F.col("_number"), F.col("_petitioner"), F.col("_respondent"), F.col("_year")))
    taken = {*tribunal.extra, *tribunal.fields.values(), *TAKEN}
    none = F.lit(None).cast("string")
    out = {
        "case_id": extract.case_id(slug, F.col("_number"), fallback, context, ("year",)),
        "case_number": F.col("_number"),
        "court": F.lit(tribunal.name),
        "court_type": F.lit(tribunal.court_type),
        "bench": F.col("_bench"),
        "bench_strength": F.lit(0),
        "country_code": extract.first_nonempty(_text(r, "country_code"), code, F.lit("IN")),
        "state_code": none,
        "state_name": none,
        "language_code": F.lit("en"),
        "decision_date": F.concat("_date", F.lit(" 00:00:00")),
        "year": F.col("_year"),
        "disposition": none,
        "case_type": F.nullif(raw("case_type"), F.lit("")),
        "petitioner": F.col("_petitioner"),
        "respondent": F.col("_respondent"),
        "judges": F.coalesce(F.when(judges.isNotNull(), listed), extract.judges(raw("judges")), F.array().cast("array<string>")),
        "title": title,
        "description": title,
        "acts_referenced": F.array().cast("array<string>"),
        "cases_cited": F.array().cast("array<string>"),
        "cited_by_count": F.lit(0),
        "pdf_url": F.coalesce("_local", "_url"),
        "source_pdf_url": F.coalesce("_url", "_local"),
        "source_url": F.coalesce(raw("source_url"), _text(r, "source_url")),
        "tribunal": F.lit(slug),
        "raw_metadata": F.map_filter(r, lambda k, v: ~k.isin(sorted(taken)) & ~F.is_variant_null(v)),
        "scraped_at": _text(r, "scraped_at"),
        "source_file": path,
        "is_judgment": is_judgment(r, path, tribunal.judgment),
    }
    extra = {name: _text(r, name) for name in tribunal.extra if name not in out}
    if slug == "itat":
        if "assessment_year" in extra:
            extra["assessment_year"] = extract.assessment_year(extra["assessment_year"])
        extra |= cities
    return rows.select(*(out[c].alias(c) for c in COMMON), *(v.alias(k) for k, v in extra.items()))


def union(parts: Iterable[DataFrame]) -> DataFrame:
    """Records of several tribunals together; extra fields that a tribunal doesn't have are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
