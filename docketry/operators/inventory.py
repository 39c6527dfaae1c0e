"""Inventories: what collections hold by date, state, issuer, folder and class, and joins of cases with what is known of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import naming
from . import joins


def date_range(rows: DataFrame, group: Sequence[str], date: str) -> DataFrame:
    """Earliest and latest date per group."""
    return rows.groupBy(*group).agg(F.min(date).alias("earliest"), F.max(date).alias("latest"))


def listed_counts(rows: DataFrame, group: str, field: str) -> DataFrame:
    """Per group one text "value:count, ..." of a field's values, in their order."""
    counts = rows.filter(F.col(field).isNotNull()).groupBy(group, F.col(field).cast("string").alias("value")).agg(F.count("*").alias("n"))
    pair = F.concat("value", F.lit(":"), F.col("n").cast("string"))
    return counts.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("value", pair.alias("pair")))), lambda x: x["pair"]), ", ").alias(field))


def state_detail(rows: DataFrame, state: str, act: str, fields: Sequence[str]) -> DataFrame:
    """Per state its distinct acts, its provisions, and the counts of some fields' values."""
    out = rows.groupBy(state).agg(F.count_distinct(act).alias("acts"), F.count("*").alias("provisions"))
    for field in fields:
        out = out.join(listed_counts(rows, state, field), state, "left")
    return out


def merged_distribution(collections: Sequence[DataFrame], dimensions: Sequence[str]) -> DataFrame:
    """Counts of the values of each dimension over several collections, added up; a collection may lack a dimension."""
    out = None
    for rows in collections:
        for d in dimensions:
            if d in rows.columns:
                part = rows.filter(F.col(d).isNotNull()).groupBy(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")).agg(F.count("*").alias("n"))
                out = part if out is None else out.unionByName(part)
    return out.groupBy("dimension", "value").agg(F.sum("n").alias("n"))


def issuers(provisions: DataFrame, act: str, year: str) -> DataFrame:
    """Per issuer of acts: instruments, provisions, first and last year and how many instruments have one; ``adds_up`` says whether the parts make the whole."""
    acts = provisions.groupBy(act).agg(F.count("*").alias("provisions"), F.max(year).alias("year"))
    of = acts.select(naming.issuer(F.col(act)).alias("i"), "provisions", "year").select("i.*", "provisions", "year")
    out = of.groupBy("issuer", "kind").agg(
        F.count("*").alias("instruments"), F.sum("provisions").alias("provisions"), F.min("year").alias("earliest_year"), F.max("year").alias("latest_year"), F.count("year").alias("instruments_with_year")
    )
    return out


def adds_up(parts: DataFrame, columns: Sequence[str], whole: DataFrame) -> DataFrame:
    """Per column the sum over ``parts``, what ``whole`` (one row) has, and whether they agree."""
    sums = parts.agg(*(F.sum(c).alias(c) for c in columns)).crossJoin(F.broadcast(whole.select(*(F.col(c).alias(f"_{c}") for c in columns))))  # two single rows
    rows = F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).alias("parts"), F.col(f"_{c}").alias("whole")) for c in columns))
    return sums.select(F.explode(rows).alias("x")).select("x.*", (F.col("x.parts") == F.col("x.whole")).alias("reconciles"))


def objects_by_folder(objects: DataFrame, key: str = "key", size: str = "bytes", modified: str = "modified") -> DataFrame:
    """Objects and bytes by folder and extension, by folder, and in all ("__total__"), with the oldest and newest."""
    named = objects.select(naming.folder(F.col(key)).alias("folder"), naming.extension(F.col(key)).alias("extension"), F.col(size).alias("size"), F.col(modified).alias("modified"))
    out = named.rollup("folder", "extension").agg(
        F.count("*").alias("objects"), F.sum("size").alias("bytes"), F.min("modified").alias("oldest"), F.max("modified").alias("newest"), F.grouping_id().alias("level")
    )
    return out.withColumns({"folder": F.when(F.col("level") > 1, "__total__").otherwise(F.col("folder")), "extension": F.when(F.col("level") > 0, "__total__").otherwise(F.col("extension"))}).drop("level")


def class_shares(sample: DataFrame, group: str, kind: str) -> DataFrame:
    """Per group and class how many sampled documents there are, and their percentage of the group, to one decimal."""
    counts = sample.groupBy(group, kind).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(W.partitionBy(group)), 1))


def upper_median(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Per group the element at n // 2 of the sorted values that aren't zero; 0 for none."""
    sizes = rows.groupBy(group, value).agg(F.count("*").alias("c"))
    used = sizes.filter(F.col(value) > 0)
    upto = W.partitionBy(group).orderBy(value)
    ranked = used.withColumns({"upto": F.sum("c").over(upto), "n": F.sum("c").over(W.partitionBy(group))})
    median = ranked.filter(F.col("upto") > F.floor(F.col("n") / 2)).groupBy(group).agg(F.min(value).alias("median"))
    return sizes.select(group).distinct().join(median, group, "left").withColumn("median", F.coalesce("median", F.lit(0)))


def estimates(totals: DataFrame, shares: DataFrame, group: str, kind: str, wanted: str) -> DataFrame:
    """Per group of ``totals`` (group, objects) the estimated objects of the wanted class; groups without a sample have none."""
    pct = shares.filter(F.col(kind) == wanted).select(group, "pct")
    sampled = shares.select(group).distinct().withColumn("sampled", F.lit(True))
    share = F.when(F.col("sampled"), F.coalesce("pct", F.lit(0.0)))
    return totals.join(sampled, group, "left").join(pct, group, "left").select(group, "objects", share.alias("pct"), F.round(F.col("objects") * share / 100).cast("long").alias("estimate"))


def corruption_report(chunks: DataFrame, case: str, score: str, order: str, text: str, least_score: float) -> DataFrame:
    """Per case with a corrupted chunk: how many, their ratio, average and highest score, a class, three samples, and the report's rank."""
    bad = F.col(score) >= least_score
    samples = F.slice(F.array_sort(F.collect_list(F.when(bad, F.struct(order, text)))), 1, 3)
    found = chunks.groupBy(case).agg(
        F.count("*").alias("chunks"), F.count_if(bad).alias("corrupted"), F.avg(F.when(bad, F.col(score))).alias("average"), F.max(F.when(bad, F.col(score))).alias("highest"), samples.alias("samples")
    )
    found = found.filter("corrupted > 0").withColumn("ratio", F.col("corrupted") / F.col("chunks"))
    found = found.withColumn("class", naming.corruption_class(F.col("ratio"), F.col("average"), least_score=least_score))
    rounded = found.withColumns({"ratio": F.round("ratio", 3), "average": F.round("average", 3), "highest": F.round("highest", 3)})
    place = F.when(F.col("class") == "DEFINITE", 0).when(F.col("class") == "PARTIAL", 1).otherwise(2)
    return rounded.select(case, "chunks", "corrupted", "ratio", "average", "highest", "class", F.array_join(F.transform("samples", lambda s: s[text]), " | ").alias("samples"), place.alias("place"))


def table_counts(names: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """Every name with its number of rows, 0 for names without any."""
    return names.join(rows.groupBy(name).agg(F.count("*").alias("n")), name, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def capped_texts(chunks: DataFrame, case: str, order: str, text: str, most_chunks: int = 20, most_chars: int = 50_000) -> DataFrame:
    """One text per case, of its first chunks, each followed by an empty line, until the text is longer than the cap; cases of blank text are left out."""
    in_order = W.partitionBy(case).orderBy(order)
    long_as = F.length(F.coalesce(F.col(text), F.lit(""))) + 2
    before = F.coalesce(F.sum(long_as).over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = chunks.withColumns({"_no": F.row_number().over(in_order), "_before": before}).filter((F.col("_no") <= most_chunks) & (F.col("_before") <= most_chars))
    ordered = F.array_sort(F.collect_list(F.struct("_no", F.coalesce(F.col(text), F.lit("")).alias("t"))))
    joined = first.groupBy(case).agg(F.count("*").alias("chunks"), F.array_join(F.transform(ordered, lambda x: F.concat(x["t"], F.lit("\n\n"))), "").alias(text))
    return joined.filter(F.trim(F.replace(text, F.lit("\n"), F.lit(" "))) != "")


def with_metadata(documents: DataFrame, metadata: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Documents with the metadata of their key, the last row of it; documents without any stay."""
    return documents.join(joins.last_per_key(metadata, [key], order), key, "left")


def resolved_markers(markers: DataFrame, notes: DataFrame, document: str, marker: str, order: Sequence[str]) -> DataFrame:
    """Inline markers with the body of their footnote in the same document; a marker's last definition counts."""
    return markers.join(joins.last_per_key(notes, [document, marker], order), [document, marker], "left")


def work_queue(items: DataFrame, axes: Mapping[str, Sequence[object]], done: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every item with every value of the given short lists, less the keys that are done."""
    for name, values in axes.items():
        items = items.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return items.join(done.select(*key).distinct(), list(key), "left_anti")


def matching(rows: DataFrame, must: Mapping[str, object]) -> DataFrame:
    """Rows whose fields have a value, one of a list of values, or lie in a range (lo, hi), either end open with None."""
    good: Column = F.lit(True)
    for field, wanted in must.items():
        c = F.col(field)
        if isinstance(wanted, tuple):
            lo, hi = wanted
            good = good & (F.lit(True) if lo is None else c >= F.lit(lo)) & (F.lit(True) if hi is None else c < F.lit(hi))
        elif isinstance(wanted, list):
            good = good & c.isin(wanted)
        else:
            good = good & (c == F.lit(wanted))
    return rows.filter(good)


def latest(rows: DataFrame, date: str, key: str, today: Column, most: int) -> DataFrame:
    """The latest rows that aren't dated in the future, ties by key: a list of the top ``most``."""
    return rows.filter(F.col(date) <= today).orderBy(F.desc(date), key).limit(most)


def parquet_sizes(paths: Mapping[str, DataFrame]) -> DataFrame:
    """Per table its columns and rows; counting a Parquet table reads its footers alone."""
    out = None
    for name, frame in paths.items():
        part = frame.agg(F.lit(name).alias("name"), F.lit(len(frame.columns)).alias("columns"), F.count("*").alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out
