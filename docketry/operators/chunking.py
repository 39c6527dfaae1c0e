"""Splitting texts into chunks with provenance, and texts of acts into provisions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import classify, extract

# Separators from coarse to fine, and the sizes of judgments' chunks.
SEPARATORS = ("\n\n\n", "\n\n", "\n", ". ", " ", "")
SIZE, OVERLAP, SMALLEST = 4096, 819, 300
# Headings of acts, most of which may stand behind quote or bold marks.
HEADINGS: list[tuple[str, str, int]] = [
    ("chapter_heading", r"^(?:#{1,3}\s+)?(?:\*\*)?(?:CHAPTER|Chapter)\s+([IVXLCDM]+|\d+[A-Z]?)\b", 40),
    ("part_heading", r"^(?:#{1,3}\s+)?(?:\*\*)?(?:PART|Part)\s+([IVXLCDM]+|\d+[A-Z]?)\b", 40),
    ("preamble", r"(?i)^(An\s+Act\s+to\b|STATEMENT\s+OF\s+OBJECTS\s+AND\s+REASONS)", 60),
    ("schedule", r"(?i)^((?:THE\s+)?(?:FIRST|SECOND|THIRD|FOURTH|FIFTH|SIXTH|SEVENTH|EIGHTH|NINTH|TENTH|ELEVENTH|TWELFTH|\d+(?:ST|ND|RD|TH)?)\s+SCHEDULE\b|SCHEDULE\s*$)", 50),
    ("article", r"^(?:Article|Art\.?)\s+(\d+[A-Z]{0,2})\b", 80),
    ("section", r"^(?:>\s*)?(?:\d{1,3}\[\s*)?(?:\[\d{1,3}\]\s*)?(?:\*\*)?(\d+[A-Z]{0,2})\.\s", 80),
]
# What footnotes say that look like sections, with and without a quote mark.
QUOTED_FOOTNOTES = r"Subs|Ins|Rep|Omitted|Added|The\s+words|The\s+figures|The\s+brackets|Cl\.|S\.\s|See\s|Renumbered|Now\s|Clause|Sub-section|Cf\.|This\s+Act|The\s+proviso|Section\s+\d"
FOOTNOTES = r"Subs|Ins|Rep|Omitted|Added|The\s+words|The\s+figures|Cl\.|S\.\s|See\s|Renumbered|Now\s|Clause|Sub-section|Cf\."
FOOTNOTE_LINE = rf"(?i)^\s*(?:>\s*\d{{1,3}}\.\s*(?:{QUOTED_FOOTNOTES})|\d{{1,3}}\.\s+(?:{FOOTNOTES}))"
# A list of contents, and what ends it; without an end it has so many characters, and a fifth of the text at most.
CONTENTS, BODY = r"(?i)ARRANGEMENT\s+OF\s+SECTIONS", r"(?i)An\s+Act\s+to|Be\s+it\s+enacted|Preamble|ACT\s+NO\.\s+\d+"
CONTENTS_LENGTH = 3000


def split_text(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separators that do, each opening with some of the last one's end."""
    separator = next((s for s in separators if s == "" or s in text), "")
    finer = separators[separators.index(separator) + 1 :] if separator in separators else ()
    # a separator stays with the piece that it opens
    pieces = list(text) if not separator else [p for p in [text.split(separator)[0], *(separator + x for x in text.split(separator)[1:])] if p]
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        joined = "".join(held).strip()
        if joined:
            out.append(joined)

    total = 0
    for piece in pieces:
        if len(piece) >= size and finer:
            flush()
            held, total = [], 0
            out += split_text(piece, size, overlap, finer)
            continue
        if held and total + len(piece) > size:
            flush()
            while held and (total > overlap or total + len(piece) > size):
                total -= len(held.pop(0))
        held.append(piece)
        total += len(piece)
    flush()
    return out


def chunk(documents: DataFrame, size: int = SIZE, overlap: int = OVERLAP, smallest: int = SMALLEST, id: str = "doc_id") -> DataFrame:
    """Chunks of ``documents`` (id, text): chunk_index, total_chunks, char_start, char_end, text_original.

    Chunks of fewer than ``smallest`` characters go; the others keep their
    index, and total_chunks counts what stays.  Null and empty texts have none.
    """
    kind = documents.schema[id].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, at = [], 0
                for i, piece in enumerate(split_text(text or "", size, overlap)):
                    if len(piece) < smallest:
                        continue
                    start = text.find(piece, at)
                    start = start if start >= 0 else max(text.find(piece), 0)
                    rows.append((i, start, start + len(piece), piece))
                    at = start + 1
                if rows:
                    index, begin, end, pieces = zip(*rows, strict=True)
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * n, batch.column(0).type), pa.array(index, pa.int64()), pa.array([n] * n, pa.int64()), pa.array(begin, pa.int64()), pa.array(end, pa.int64()), pa.array(pieces, pa.string())],
                        names=[id, "chunk_index", "total_chunks", "char_start", "char_end", "text_original"],
                    )

    return documents.select(id, "text").mapInArrow(split, f"`{id}` {kind}, chunk_index long, total_chunks long, char_start long, char_end long, text_original string")


def with_context(chunks: DataFrame, title: Column, citation: Column, year: Column, court: Column | None = None) -> DataFrame:
    """``chunks`` with section type and priority, and ``text`` under a header that says what it is from."""
    kind = classify.section_type(F.col("text_original"))
    typed = chunks.withColumns({"section_type": kind, "section_priority": classify.section_priority(kind)})
    return typed.withColumn("text", F.concat(extract.case_header(title, citation, year, F.col("section_type"), court), "text_original"))


def provisions(acts: DataFrame, id: str = "act_id") -> DataFrame:
    """Boundaries of ``acts`` (id, text): type, number, priority, [char_start, char_end), and the chapter and part they stand in.

    Lines of footnotes, and of a list of contents, are no sections; a first preamble counts alone.
    """
    lines = acts.select(id, F.length("text").alias("whole"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    in_order = W.partitionBy(id).orderBy("line_no")
    so_far = in_order.rowsBetween(W.unboundedPreceding, 0)
    starts = F.coalesce(F.sum(F.length("line") + 1).over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    kind, number, priority = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("int")
    for name, pattern, value in reversed(HEADINGS):
        hit = F.col("line").rlike(pattern)
        kind, number, priority = F.when(hit, name).otherwise(kind), F.when(hit, F.regexp_extract("line", pattern, 1)).otherwise(number), F.when(hit, value).otherwise(priority)
    marked = lines.withColumns({"char_start": starts, "type": kind, "number": number, "priority": priority})
    is_list = F.col("line").rlike(CONTENTS)
    list_end = F.min(F.when(is_list, F.col("char_start") + F.length(F.regexp_substr("line", F.lit(f"^.*?{CONTENTS}"))))).over(so_far)
    marked = marked.withColumns({"listed_to": list_end, "preamble_no": F.sum((F.col("type") == "preamble").cast("int")).over(so_far)})
    # the body begins with the first line after the list that says so
    is_body = F.col("line").rlike(BODY) & (F.col("char_start") >= F.col("listed_to"))
    everything = W.partitionBy(id).orderBy("line_no").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    body = F.min(F.when(is_body, F.col("char_start"))).over(everything)
    skipped_to = F.coalesce(body, F.least(F.col("listed_to") + CONTENTS_LENGTH, F.floor(F.col("whole") / 5)))
    marked = marked.withColumn("listed", F.coalesce(F.col("char_start") < F.when(F.col("listed_to").isNotNull(), skipped_to), F.lit(False)))
    found = marked.filter("type is not null and not (type = 'section' and listed) and not (type = 'preamble' and preamble_no > 1)")
    found = found.filter(~((F.col("type") == "section") & F.col("line").rlike(FOOTNOTE_LINE)))
    end = F.coalesce(F.lead("char_start").over(in_order), F.col("whole"))
    carried = in_order.rowsBetween(W.unboundedPreceding, 0)
    return found.select(
        id, "type", "number", "priority", "char_start", end.alias("char_end"),
        F.last(F.when(F.col("type") == "chapter_heading", F.col("number")), True).over(carried).alias("chapter"),
        F.last(F.when(F.col("type") == "part_heading", F.col("number")), True).over(carried).alias("part"),
    )


def unique_ids(chunks: DataFrame, group: str, base: str, order: str) -> DataFrame:
    """``chunk_id``: the base id, with ``_d1``, ``_d2`` and so on where it is used again within its group."""
    again = F.row_number().over(W.partitionBy(group, base).orderBy(order)) - 1
    return chunks.withColumn("chunk_id", F.when(again > 0, F.concat(F.col(base), F.lit("_d"), again.cast("string"))).otherwise(F.col(base)))
