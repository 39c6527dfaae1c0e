"""Exact-count audits: facets, coverage, pivots, rollups, periods, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def facet(rows: DataFrame, *by: str) -> DataFrame:
    """Exact number of rows per value."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def missing_fields(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per field how many rows have nothing in it (null, empty text, empty list), and the percentage."""
    kinds = dict(rows.dtypes)

    def empty(f: str) -> Column:
        c = F.col(f)
        if kinds[f] == "string":
            return c.isNull() | (c == "")
        return c.isNull() | (F.size(c) == 0) if kinds[f].startswith(("array", "map")) else c.isNull()

    counts = rows.agg(F.count("*").alias("total"), *(F.count_if(empty(f)).alias(f) for f in fields))
    long = counts.select("total", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("missing")) for f in fields))).alias("x"))
    return long.select("x.field", "x.missing", "total", F.round(F.col("missing") * 100 / F.col("total"), 2).alias("pct"))


def parts_per_case(rows: DataFrame, group: Sequence[str], case: str) -> DataFrame:
    """Distinct cases per group and how many rows they have: min, p50, p95, max, mean.

    Percentiles are elements of the sorted counts: at n // 2 and at int(0.95 n), the last at most.
    """
    per_case = rows.groupBy(*group, case).agg(F.count("*").alias("parts"))
    # a histogram of counts stays small however many cases a group has
    sizes = per_case.groupBy(*group, "parts").agg(F.count("*").alias("cases"))
    upto = W.partitionBy(*group).orderBy("parts")
    ranked = sizes.withColumns({"upto": F.sum("cases").over(upto), "n": F.sum("cases").over(W.partitionBy(*group))})

    def element(place: Column) -> Column:
        return F.min(F.when(F.col("upto") > place, F.col("parts")))

    return ranked.groupBy(*group).agg(
        F.max("n").alias("cases"),
        F.sum(F.col("parts") * F.col("cases")).alias("rows"),
        F.min("parts").alias("min"),
        element(F.floor(F.col("n") / 2)).alias("p50"),
        element(F.least(F.col("n") - 1, F.floor(F.col("n") * 95 / 100))).alias("p95"),
        F.max("parts").alias("max"),
        (F.sum(F.col("parts") * F.col("cases")) / F.max("n")).alias("mean"),
    )


def overlap_of_periods(rows: DataFrame, group: str, period: str, case: str) -> DataFrame:
    """Distinct cases per group against the sum of those per period; the difference is cases in more than one."""
    per = rows.groupBy(group, period, case).agg(F.lit(1).alias("one"))
    summed = per.groupBy(group).agg(F.count("*").alias("sum_of_periods"), F.count_distinct(case).alias("cases"))
    return summed.withColumn("overlap", F.col("sum_of_periods") - F.col("cases"))


def year_matrix(rows: DataFrame, year: str, across: str, values: Sequence[str], measure: Column) -> DataFrame:
    """A row per year, a column per value (null for none), and the row's total."""
    pivoted = rows.groupBy(year).pivot(across, list(values)).agg(measure)
    return pivoted.withColumn("total", sum((F.coalesce(F.col(f"`{v}`"), F.lit(0)) for v in values), F.lit(0)))


def rollup_distinct(rows: DataFrame, first: str, second: str, entity: str) -> DataFrame:
    """Distinct entities by two dimensions, with totals that are distinct too, not sums."""
    out = rows.rollup(first, second).agg(F.count_distinct(entity).alias("entities"), F.count("*").alias("rows"), F.grouping_id().alias("level"))
    return out.withColumns({first: F.when(F.col("level") > 1, "__total__").otherwise(F.col(first).cast("string")), second: F.when(F.col("level") > 0, "__total__").otherwise(F.col(second).cast("string"))}).drop("level")


def by_dimensions(rows: DataFrame, dimensions: Sequence[str], entity: str) -> DataFrame:
    """Distinct entities and rows by each dimension on its own, in one pass."""
    out = rows.groupingSets([[d] for d in dimensions], *dimensions).agg(F.count_distinct(entity).alias("entities"), F.count("*").alias("rows"), *(F.grouping(d).alias(f"_{d}") for d in dimensions))
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for d in dimensions:
        name, value = F.when(F.col(f"_{d}") == 0, d).otherwise(name), F.when(F.col(f"_{d}") == 0, F.col(d).cast("string")).otherwise(value)
    return out.select(name.alias("dimension"), value.alias("value"), "entities", "rows")


def core_period(counts: DataFrame, group: str, year: str, n: str) -> DataFrame:
    """Per group the years in which the running share of ``n`` first reaches 5 % and 95 %."""
    running = F.sum(n).over(W.partitionBy(group).orderBy(year)) * 100
    whole = F.sum(n).over(W.partitionBy(group))
    shares = counts.withColumns({"running": running, "whole": whole})
    return shares.groupBy(group).agg(
        F.min(F.when(F.col("running") >= 5 * F.col("whole"), F.col(year))).alias("core_from"),
        F.min(F.when(F.col("running") >= 95 * F.col("whole"), F.col(year))).alias("core_to"),
        F.max("whole").alias("total"),
    )


def cutoff_year(counts: DataFrame, group: str, year: str, n: str, percent: int = 25) -> DataFrame:
    """Per group the last year that has at least a quarter of the best year's count."""
    peak = F.max(n).over(W.partitionBy(group))
    return counts.withColumn("peak", peak).filter(F.col(n) * 100 >= percent * F.col("peak")).groupBy(group).agg(F.max(year).alias("cutoff"), F.max("peak").alias("peak"))


def dense_years(counts: DataFrame, group: str, year: str, n: str, least: int) -> DataFrame:
    """Per group the first year with at least so many, and the number of such years."""
    dense = F.col(n) >= least
    return counts.groupBy(group).agg(F.min(F.when(dense, F.col(year))).alias("first_dense"), F.count_if(dense).alias("dense_years"))


def ranked(counts: DataFrame, by: str, name: str) -> DataFrame:
    """Place, share of all in percent and how many are larger; ties share a place."""
    order = W.orderBy(F.desc(by))  # a row per group
    return counts.withColumns(
        {"place": F.rank().over(order), "share": F.round(F.col(by) * 100 / F.sum(by).over(W.partitionBy(F.lit(0))), 2)}
    ).withColumn("larger", F.col("place") - 1)


def reconciled_buckets(rows: DataFrame, value: Column, low: int, high: int) -> DataFrame:
    """Counts by value, with buckets for null, too low and too high; ``whole`` tells whether they sum to all rows."""
    bucket = F.when(value.isNull(), "null").when(value < low, "below").when(value > high, "above").otherwise(value.cast("string"))
    counts = rows.select(bucket.alias("bucket")).rollup("bucket").agg(F.count("*").alias("n"), F.grouping("bucket").alias("all"))
    everything = W.partitionBy(F.lit(0))  # a row per bucket
    total, summed = F.max(F.when(F.col("all") == 1, F.col("n"))).over(everything), F.sum(F.when(F.col("all") == 0, F.col("n"))).over(everything)
    return counts.withColumn("whole", summed == total).filter(F.col("all") == 0).drop("all")


def merged_collections(rows: DataFrame, group: str) -> DataFrame:
    """Collections merged under one name: sums, extremes and the set of collections.

    ``rows`` has collection, cases, duplicates, earliest and latest."""
    return rows.groupBy(group).agg(
        (F.sum("cases") - F.sum(F.coalesce("duplicates", F.lit(0)))).alias("cases"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
        F.array_sort(F.collect_set("collection")).alias("collections"),
    )


def tagged_union(tables: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """UNION ALL of tables under a tag; columns that a table lacks are null."""
    out = None
    for tag, table in tables.items():
        part = table.select(F.lit(tag).alias("tag"), *(F.col(c) if c in table.columns else F.lit(None).alias(c) for c in columns))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def distribution(rows: DataFrame, field: str, unknown: str = "unknown") -> DataFrame:
    """How many rows have each value of a field, nulls as ``unknown``, with their share in percent; by falling count in the report's order, ``place``."""
    counts = rows.groupBy(F.coalesce(F.col(field).cast("string"), F.lit(unknown)).alias(field)).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n").alias("_all"))
    found = counts.crossJoin(F.broadcast(whole))  # one row
    # a row per value: the report's order needs them together
    place = F.row_number().over(W.orderBy(F.desc("n"), field))
    return found.select(field, "n", F.round(F.col("n") * 100 / F.col("_all"), 2).alias("share"), place.alias("place"))
