"""Joins of collections: overlap, reconciliation, cascades, as-of, ranges, upserts, graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def set_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys of each side, those shared, and those of both without duplicates."""
    sides = left.select(key, F.lit(1).alias("side")).unionByName(right.select(key, F.lit(2).alias("side")))
    per_key = sides.groupBy(key).agg(F.count_if(F.col("side") == 1).alias("a"), F.count_if(F.col("side") == 2).alias("b")).filter(F.col(key).isNotNull())
    return per_key.agg(
        F.count_if(F.col("a") > 0).alias("left_keys"), F.count_if(F.col("b") > 0).alias("right_keys"), F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("shared"), F.count("*").alias("deduplicated")
    )


def present_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``."""
    return left.join(right.select(key), key, "left_semi")


def mirror_status(local: DataFrame, index: DataFrame, bucket: DataFrame, key: str) -> DataFrame:
    """Local keys as mirrored, NOT_in_bucket, or no_index_entry."""
    seen = local.join(index.select(key).distinct().withColumn("indexed", F.lit(True)), key, "left").join(bucket.select(key).distinct().withColumn("stored", F.lit(True)), key, "left")
    status = F.when(F.col("indexed").isNull(), "no_index_entry").when(F.col("stored").isNull(), "NOT_in_bucket").otherwise("mirrored")
    return seen.select(key, status.alias("status"))


def reconcile(left: DataFrame, right: DataFrame, key: str, n: str) -> DataFrame:
    """Counts of both sides per key with the difference, its percentage of the left and its direction."""
    a, b = left.select(key, F.col(n).alias("left_n")), right.select(key, F.col(n).alias("right_n"))
    both = a.join(b, key, "full_outer").na.fill(0, ["left_n", "right_n"])
    delta = F.col("right_n") - F.col("left_n")
    return both.withColumns(
        {"delta": delta, "delta_pct": F.round(F.try_divide(delta * 100, F.col("left_n")), 3), "direction": F.when(delta > 0, "more").when(delta < 0, "fewer").otherwise("same")}
    )


def net_of_duplicates(cases: DataFrame, duplicates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cases per key less the duplicates counted there; keys with none left go."""
    net = F.col("cases") - F.coalesce("duplicates", F.lit(0))
    return cases.join(duplicates, list(keys), "left").withColumn("net", net).filter("net > 0").select(*keys, "net")


def cascade(left: DataFrame, right: DataFrame, strategies: Sequence[tuple[str, Column, Column]], right_id: str) -> DataFrame:
    """``left`` with the match of the first strategy (name, left key, right key) that has one.

    Each strategy is an equi-join with the smallest right id per key; null keys match nothing.
    """
    out = left
    for k, (_, left_key, right_key) in enumerate(strategies):
        table = right.select(right_key.alias(f"_k{k}"), F.col(right_id)).filter(F.col(f"_k{k}").isNotNull()).groupBy(f"_k{k}").agg(F.min(right_id).alias(f"_m{k}"))
        out = out.withColumn("_key", left_key).join(table, F.col("_key") == F.col(f"_k{k}"), "left").drop("_key", f"_k{k}")
    matches = [f"_m{k}" for k in range(len(strategies))]
    strategy = F.coalesce(*(F.when(F.col(m).isNotNull(), name) for m, (name, *_) in zip(matches, strategies, strict=True)))
    return out.withColumns({"match": F.coalesce(*matches), "strategy": strategy}).drop(*matches)


def prefix_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str, length: int) -> DataFrame:
    """Pairs in which one key starts with the other and both have at least ``length`` characters.

    They share their first ``length`` characters, which makes it an equi-join.
    """
    a = left.filter(F.length(left_key) >= length).withColumn("_head", F.substring(left_key, 1, length))
    b = right.filter(F.length(right_key) >= length).withColumn("_head", F.substring(right_key, 1, length))
    return a.join(b, "_head").filter(F.startswith(left_key, F.col(right_key)) | F.startswith(right_key, F.col(left_key))).drop("_head")


def as_of(rows: DataFrame, marks: DataFrame, group: Sequence[str], at: str, value: str) -> DataFrame:
    """``rows`` with the value of the latest mark at or before them within their group; one shuffle, no pairs."""
    both = rows.withColumns({value: F.lit(None).cast(dict(marks.dtypes)[value]), "_row": F.lit(1)}).unionByName(marks.select(*group, at, value).withColumn("_row", F.lit(0)), allowMissingColumns=True)
    latest = F.last(value, ignorenulls=True).over(W.partitionBy(*group).orderBy(at, "_row").rowsBetween(W.unboundedPreceding, 0))
    return both.withColumn(value, latest).filter("_row = 1").drop("_row")


def pages_of_span(pages: Column, start: Column, end: Column) -> Column:
    """First and last page number whose [char_start, char_end) meets [start, end); null if none does."""
    met = F.filter(pages, lambda p: (p["char_start"] < end) & (p["char_end"] > start))
    return F.struct(F.array_min(F.transform(met, lambda p: p["page_number"])).alias("page_start"), F.array_max(F.transform(met, lambda p: p["page_number"])).alias("page_end"))


def with_offsets(parts: DataFrame, group: Sequence[str], order: str, text: str, separator: int) -> DataFrame:
    """Running character offsets of parts joined by a separator of so many characters."""
    before = F.coalesce(F.sum(F.length(text) + separator).over(W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return parts.withColumn("char_start", before).withColumn("char_end", F.col("char_start") + F.length(text))


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key: whole rows, by an aggregate that combines before the shuffle."""
    others = [c for c in rows.columns if c not in key]
    first = rows.groupBy(*key).agg(F.min(F.struct(*order, *(c for c in others if c not in order))).alias("_first"))
    return first.select(*key, *(F.col(f"_first.{c}").alias(c) for c in others))


def last_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    others = [c for c in rows.columns if c not in key]
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_last"))
    return last.select(*(c if c in key else F.col(f"_last.{c}").alias(c) for c in rows.columns))


def upsert(current: DataFrame, incoming: DataFrame, key: Sequence[str], merge: bool = True, order: Sequence[str] = ()) -> DataFrame:
    """``current`` with ``incoming`` rows added; on a conflict the incoming row wins if merging, else the current one.

    Of incoming rows with the same key one lands: the last by ``order`` if merging, else the first (by all other columns, if no order is given).
    """
    order = list(order) or [c for c in incoming.columns if c not in key]
    one = last_per_key(incoming, key, order) if merge else first_per_key(incoming, key, order).select(*incoming.columns)
    if merge:
        return current.join(one.select(*key), list(key), "left_anti").unionByName(one)
    return current.unionByName(one.join(current.select(*key), list(key), "left_anti"))


def reassembled(parts: DataFrame, case: str, order: str, text: str, separator: str = "\n") -> DataFrame:
    """One text per case, of its parts in their order."""
    ordered = F.array_sort(F.collect_list(F.struct(order, text)))
    return parts.groupBy(case).agg(F.count("*").alias("parts"), F.array_join(F.transform(ordered, lambda x: x[text]), separator).alias(text))


def citation_edges(cited: DataFrame, cases: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Edges (citing, cited) of a citation graph: ``cited`` (citing, key) resolved by ``cases`` (key, case_id).

    Self-loops, repetitions and edges that exist already are left out.
    """
    edges = cited.join(cases.groupBy("key").agg(F.min("case_id").alias("cited")), "key").filter("citing <> cited").select("citing", "cited").distinct()
    return edges if existing is None else edges.join(existing.select("citing", "cited"), ["citing", "cited"], "left_anti")
