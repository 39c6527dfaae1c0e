"""Places in texts: all matches of several patterns with their offsets, what stands before each, and spans found in spite of white space.

Offsets are in characters from 0, as Spark counts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.redaction import _let


#: Fixed value: a noncharacter, which texts don't hold as a rule.
MARK = "\uffff"


def places(text: Column, pattern: str, groups: int = 0) -> Column:
    """An array of structs of all matches of a pattern, none of them empty: ``at``, ``whole`` and ``g1`` and so on; an empty array where there are none.

    A match stands behind all earlier pieces and matches.  One search marks each match and
    its groups, and the text is cut at the marks; texts that hold the mark are searched once for each part of a match.
    """
    names = ["piece", "whole", *(f"g{k}" for k in range(1, groups + 1))]
    kind = "array<struct<" + ",".join(f"{n}:string" for n in names) + ">>"

    def found(pieces: Column) -> Column:
        whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        parts = F.arrays_zip(pieces, whole, *(F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) for k in range(1, groups + 1)))
        # behind the last match one piece is left
        return _let(F.slice(parts.cast(kind), 1, F.size(whole)), lambda rows: _with_offsets(rows, groups))

    def cut(parts: Column) -> Column:
        rows = F.transform(F.sequence(F.lit(0), F.size(parts) - 2, F.lit(groups + 2)), lambda i: F.struct(*(F.get(parts, i + k).alias(n) for k, n in enumerate(names))))
        return F.when(F.size(parts) > 1, _let(rows, lambda rows: _with_offsets(rows, groups))).otherwise(F.array().cast(_kind(groups)))

    marked = F.regexp_replace(text, f"({pattern})", MARK + "".join(f"${k}{MARK}" for k in range(1, groups + 2)))
    slow = F.when(text.rlike(pattern), _let(F.split(text, pattern, -1), found)).otherwise(F.array().cast(_kind(groups)))
    return F.when(F.contains(text, F.lit(MARK)), slow).when(text.isNotNull(), _let(F.split(marked, MARK, -1), cut)).otherwise(F.array().cast(_kind(groups)))


def _kind(groups: int) -> str:
    return "array<struct<at:int,whole:string" + "".join(f",g{k}:string" for k in range(1, groups + 1)) + ">>"


def _with_offsets(rows: Column, groups: int) -> Column:
    """Offsets from the lengths of pieces and matches before; sums over all earlier rows, in one pass."""
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("at"))
    state = F.aggregate(rows, start, lambda s, r: F.struct((s["end"] + F.length(r["piece"]) + F.length(r["whole"])).alias("end"), F.array_append(s["at"], s["end"] + F.length(r["piece"])).alias("at")))
    return _let(
        state["at"], lambda at: F.transform(rows, lambda r, i: F.struct(F.get(at, i).alias("at"), r["whole"].alias("whole"), *(r[f"g{k}"].alias(f"g{k}") for k in range(1, groups + 1)))).cast(_kind(groups))
    )


def match_table(texts: DataFrame, id: str, text: str, patterns: dict[str, tuple[str, int]], after: int = 0) -> DataFrame:
    """Rows (id, ``kind``, ``at``, ``whole``, ``g1`` ...) of all matches of ``patterns``, a pattern and its number of groups by kind.

    All kinds have the columns of the one with the most groups; null where a kind
    or a match has fewer.  With ``after`` a column of that name has so many characters
    of what follows.  A null text has no rows.
    """
    most = max(n for _, n in patterns.values())

    def of(kind: str, pattern: str, groups: int) -> Column:
        padded = [F.lit(None).cast("string").alias(f"g{k}") for k in range(groups + 1, most + 1)]
        return F.transform(places(F.col(text), pattern, groups), lambda m: F.struct(F.lit(kind).alias("kind"), m["at"].alias("at"), m["whole"].alias("whole"), *(m[f"g{k}"].alias(f"g{k}") for k in range(1, groups + 1)), *padded, *follows(m)))

    def follows(m: Column) -> list[Column]:
        return [F.substr(F.col(text), m["at"] + F.length(m["whole"]) + 1, F.lit(after)).alias("after")] if after else []

    # an outer one, as Spark would search every text again to see whether there is anything to explode
    found = F.explode_outer(F.concat(*(of(k, p, n) for k, (p, n) in patterns.items())))
    return texts.filter(F.col(text).isNotNull()).select(id, found.alias("m")).filter("m is not null").select(id, "m.*")


def as_of_latest(rows: DataFrame, group: str, marks: Column, carried: Sequence[str], at: str = "at") -> DataFrame:
    """``rows`` with ``latest_*`` of the ``carried`` columns of the last row of ``marks`` at or before each; a mark comes before others in its place."""
    before = W.partitionBy(group).orderBy(at, F.when(marks, 0).otherwise(1)).rowsBetween(W.unboundedPreceding, 0)
    latest = F.last(F.when(marks, F.struct(*carried)), ignorenulls=True).over(before)
    return rows.withColumn("_latest", latest).select("*", *(F.col("_latest")[c].alias(f"latest_{c}") for c in carried)).drop("_latest")


def find_tolerant(needle: Column, text: Column, start: Column | None = None, window: int | None = None) -> Column:
    """A struct (``begin``, ``end``) of the first place of ``needle`` in ``text`` at or after ``start``: exact, or else with any white space for any.

    Both are offsets in the text as it is, not as it would be with its white space
    collapsed.  ``window`` bounds how far the second search looks.  Null where it
    isn't found, or either is null; an empty needle is found at ``start``.
    """
    start = F.lit(0) if start is None else start

    def within(rest: Column) -> Column:
        exact = F.instr(rest, needle) - 1
        looked = rest if window is None else F.substring(rest, 1, window)
        words = F.filter(F.split(needle, r"(?U)\s+"), lambda w: w != "")
        pattern = F.array_join(F.transform(words, lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))), "(?U:\\s+)")

        def loose(hit: Column) -> Column:
            begin = F.instr(looked, hit) - 1
            return F.when(hit != "", F.struct((begin + start).alias("begin"), (begin + start + F.length(hit)).alias("end")))

        tolerant = F.when(F.size(words) > 0, _let(F.regexp_substr(looked, pattern), loose))
        return F.when(exact >= 0, F.struct((exact + start).alias("begin"), (exact + start + F.length(needle)).alias("end"))).otherwise(tolerant)

    return F.when(needle.isNotNull() & text.isNotNull(), _let(F.substr(text, start + 1), within))


def span_index(spans: Column, separator: int = 2) -> Column:
    """An array of structs (``begin``, ``end``, ``span``) of texts that follow each other, parted by ``separator`` characters: where each lies in the whole."""
    zero = F.struct(F.lit(0).alias("next"), F.array().cast("array<int>").alias("at"))
    state = F.aggregate(spans, zero, lambda s, x: F.struct((s["next"] + F.length(x["text"]) + separator).alias("next"), F.array_append(s["at"], s["next"]).alias("at")))
    return _let(state["at"], lambda at: F.transform(spans, lambda x, i: F.struct(F.get(at, i).alias("begin"), (F.get(at, i) + F.length(x["text"])).alias("end"), x.alias("span"))))


def spans_between(index: Column, begin: Column, end: Column) -> Column:
    """The spans of an index that share a character with [begin, end)."""
    return F.transform(F.filter(index, lambda s: (s["begin"] < end) & (s["end"] > begin)), lambda s: s["span"])
