"""Release of a case-law collection: whole cases are barred, the rest is redacted and put on the published schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import judgments, redaction
from ..sources import sinks
from . import joins

#: What a case is: kept, not from a court, or under a direction against publication.
KEPT, THIRD_PARTY, NOT_PUBLISHED, UNKNOWN_COURT = "kept", "purged_third_party_source", "excluded_non_publication", "unknown_court_code"
#: The published columns that hold text; a chunk is judged by the first of them that it has.
TEXTS = ("text_original", "text")


def _judged(chunks: DataFrame) -> Column:
    present = [F.nullif(F.col(c), F.lit("")) for c in TEXTS if c in chunks.columns]
    return F.coalesce(*present, F.lit(""))


def case_status(chunks: DataFrame, case: str = "case_id", order: str = "chunk_index", known_courts: bool = False) -> DataFrame:
    """One row per case: ``status``, told from all its chunks together, as a direction in one bars them all.

    A chunk is judged by its original text, or by ``text`` where it has none.  The
    texts of one case are one value in one task, since a direction may run over two
    chunks; cases are bounded by what a court writes.  With ``known_courts`` a case
    whose id doesn't begin with a court's code is barred first.
    """
    whole = joins.reassembled(chunks.select(case, order, _judged(chunks).alias("_judged")), case, order, "_judged")
    text = F.col("_judged")
    status = F.when(redaction.has_furniture(text), THIRD_PARTY).when(redaction.excluded(text), NOT_PUBLISHED).otherwise(KEPT)
    if known_courts:
        status = F.when(judgments.court_name(F.col(case)).isNull(), UNKNOWN_COURT).otherwise(status)
    return whole.select(case, "parts", status.alias("status"))


def redacted_chunks(chunks: DataFrame, status: DataFrame, case: str = "case_id") -> DataFrame:
    """The chunks of kept cases with every text column redacted, and ``counts``, a map of how often each rule hit in all of them."""
    kept = chunks.join(status.filter(F.col("status") == KEPT).select(case), case, "left_semi")
    texts = [c for c in TEXTS if c in chunks.columns]
    masked = kept.withColumns({f"_{c}": redaction.redact(F.col(c)) for c in texts})
    none = F.create_map().cast("map<string,int>")
    counts = reduce(lambda a, b: F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))), [F.coalesce(F.col(f"_{c}.counts"), none) for c in texts])
    return masked.withColumns({**{c: F.col(f"_{c}.text") for c in texts}, "counts": counts}).drop(*(f"_{c}" for c in texts))


def published(chunks: DataFrame) -> DataFrame:
    """Redacted chunks on the published schema, with the fields that a release fills in itself."""
    filled = {"source_url": F.lit("")}
    for name, value in (("language_code", "en"), ("case_number", ""), ("citation", "")):
        filled[name] = F.col(name) if name in chunks.columns else F.lit(value)
    return schemas.as_published(chunks.withColumns(filled), schemas.CASE_LAW)


def release_counts(status: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows (name, n): cases by status, chunks kept, and how often each rule hit."""
    cases = status.groupBy(F.concat(F.lit("documents_"), "status").alias("name")).agg(F.count("*").alias("n"))
    kept = chunks.agg(F.lit("chunks_kept").alias("name"), F.count("*").alias("n"))
    hits = chunks.select(F.explode("counts").alias("rule", "hits")).groupBy(F.concat(F.lit("redacted_"), "rule").alias("name")).agg(F.sum("hits").cast("long").alias("n"))
    return cases.unionByName(kept).unionByName(hits)


def run(chunks: DataFrame, path: str, by: str = "court", known_courts: bool = False) -> DataFrame:
    """From raw chunks to a published folder: status, redaction, projection, gate; returns the manifest.

    Raw rows never reach the sink; a case that is barred or a row that the gate refuses isn't written.
    """
    return sinks.release(published(redacted_chunks(chunks, case_status(chunks, known_courts=known_courts))), path, schemas.CASE_LAW, by)
