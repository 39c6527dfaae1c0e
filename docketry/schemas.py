"""Published schemas, typed coercion onto them, and the repaired taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published columns, in their order.
CASE_LAW = (
    "case_id chunk_id chunk_index total_chunks text text_original char_start char_end page_start page_end section_type section_priority box_aware "
    "court court_code court_type bench bench_strength judges title description petitioner respondent disposition case_number citation "
    "decision_date date_of_registration year source_url language_code"
).split()
LEGISLATION = (
    "act_id chunk_id title chapter section_number section_title text jurisdiction state instrument_type act_status in_force doc_type provision_type "
    "section_type legal_subject has_proviso has_non_obstante delegation_type department regulatory_body acts_referenced defined_terms amendment_count year "
    "source_url language_code"
).split()
INTEGERS = "chunk_index total_chunks char_start char_end page_start page_end section_priority bench_strength year amendment_count".split()
BOOLEANS = "box_aware in_force has_proviso has_non_obstante".split()
LISTS = "judges acts_referenced defined_terms".split()
INTERNAL = "r2_key pdf_url sparse category".split()
IN_FORCE = ["in_force"]
NOT_IN_FORCE = ["superseded", "repealed", "spent"]


def as_published(raw: DataFrame, schema: list[str], decode_lists: bool = True) -> DataFrame:
    """``raw`` on a published schema: unknown columns go, missing ones are null, values are coerced, never with an error.

    Whole numbers that can't be read are null; texts are true unless empty;
    lists are decoded from JSON (or else wrapped), and never null.
    """
    have = dict(raw.dtypes)
    return raw.select(*(_coerced(name, have.get(name), decode_lists).alias(name) for name in schema))


def _coerced(name: str, kind: str | None, decode_lists: bool) -> Column:
    col = F.col(name) if kind else F.lit(None).cast("string")
    if name in INTEGERS:
        return F.trim(col).try_cast("long") if kind in (None, "string") else col.try_cast("long")
    if name in BOOLEANS:
        return col != "" if kind in (None, "string") else col.cast("boolean")
    if name in LISTS:
        if kind and kind.startswith("array"):
            return F.coalesce(F.transform(col, lambda x: x.cast("string")), F.array().cast("array<string>"))
        one = F.when(col.isNull() | (col == ""), F.array().cast("array<string>"))
        if decode_lists:
            one = one.when(col.startswith("["), F.coalesce(F.from_json(col, "array<string>"), F.array(col)))
        return one.otherwise(F.array(col.cast("string")))
    return col.cast("string")


def taxonomy(rows: DataFrame) -> DataFrame:
    """``rows`` with jurisdiction, state, instrument_type, act_status and in_force repaired; an unknown status is an error."""
    state, status = F.lower(F.trim(F.coalesce("state", F.lit("")))), F.lower(F.trim(F.coalesce("act_status", F.lit(""))))
    raw = F.lower(F.trim(F.coalesce(F.nullif("jurisdiction", F.lit("")), "category", F.lit(""))))
    checked = F.when(status.isin(IN_FORCE + NOT_IN_FORCE), status.isin(IN_FORCE)).otherwise(F.raise_error(F.concat(F.lit("unknown act_status: "), status)).cast("boolean"))
    return rows.withColumns(
        {
            "jurisdiction": F.when(state == "", "").when(state == "central", "central").otherwise("state"),
            "state": F.when(state.isin("", "central"), "").otherwise(state),
            "instrument_type": F.when(raw == "regulatory", raw).otherwise("legislation"),
            "act_status": status,
            "in_force": checked,
        }
    )


def refuse_internal(rows: DataFrame) -> None:
    """An error if ``rows`` have columns that are never published."""
    if leaked := sorted({*rows.columns} & {*INTERNAL}):
        raise ValueError(f"internal columns: {leaked}")


def gate(rows: DataFrame, texts: tuple[str, ...] = ("text", "text_original")) -> DataFrame:
    """Rows that must not be published, with a reason: no text or page furniture in any text column; internal columns are an error at once."""
    from .functions.redaction import has_furniture

    refuse_internal(rows)
    text = F.concat_ws("", *(F.col(c) for c in texts if c in rows.columns))
    reason = F.when(F.trim(text) == "", "empty text").when(has_furniture(text), "page furniture")
    return rows.withColumn("reason", reason).filter("reason is not null")
