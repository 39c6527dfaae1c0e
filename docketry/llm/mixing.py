"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

Documents are leaves of a tree: domain, then language, then source.  A token
budget is dealt from the root down.  Each parent's budget goes to its children
by weight, but no child gets more than its subtree holds over ``max_epochs``
passes; what a child can't take goes to its siblings by their weights.  As a
parent never gets more than its subtree holds, a shortage reaches an ancestor's
siblings only when all siblings are full.  Budgets are whole tokens, rounded
down at each level.

A leaf's budget is some whole epochs and a rest.  The rest is the longest
prefix, within the rest's tokens, of the leaf's documents in the order of that
epoch's seeded hash.  Prefix sums take two levels, buckets of the hash and then
documents within a bucket, so that a leaf of any size is spread over tasks, and
documents are finally held against one cut-off per leaf, so texts aren't moved.

Null languages and sources are leaves named "(none)".  Texts that are null or
without words have no tokens; they are kept when the prefix reaches them.
Repeated rows stand at the same place of the order and go together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import fresh, written

NONE = "(none)"
#: Hex digits of the hash that make a bucket: 4096 buckets a leaf.
BUCKET_DIGITS = 3


def count_words(text: Column) -> Column:
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """The domain of a source by the number in its name, one of d0 to d3."""
    number = F.regexp_extract(source, r"(\d{1,9})", 1)
    return F.when(number != "", F.concat(F.lit("d"), (number.cast("int") % 4).cast("string"))).otherwise(NONE)


def _weight(column: str, weights: dict[str, int]) -> Column:
    """Whole-number weights by name; 1 for names that aren't listed."""
    return F.coalesce(*(F.when(F.col(column) == k, v) for k, v in weights.items()), F.lit(1)).cast("long")


def _dealt(children: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """``children`` (parents, name, weight, capacity, total: the parent's budget) with their ``budget``."""
    of = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(0))
    # in the order in which children fill up; without weight last
    by_fill = of.orderBy(F.when(F.col("weight") == 0, 1).otherwise(0), F.col("capacity") / F.greatest("weight", F.lit(1)), name)
    filled = children.withColumns(
        {
            "left": F.col("total") - F.coalesce(F.sum("capacity").over(by_fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "weights": F.sum("weight").over(by_fill.rowsBetween(W.currentRow, W.unboundedFollowing)),
            "place": F.row_number().over(by_fill),
        }
    )
    open_ = F.col("capacity") * F.col("weights") > F.col("weight") * F.col("left")
    level = F.min(F.when(open_, F.struct("place", "left", "weights"))).over(of)
    filled = filled.withColumn("level", level)
    share = F.floor(F.try_divide(F.col("weight") * F.col("level.left"), F.col("level.weights")))
    budget = F.when(F.col("level").isNull() | (F.col("place") < F.col("level.place")), F.col("capacity")).otherwise(F.coalesce(share, F.lit(0)))
    return filled.withColumn("budget", F.greatest(F.lit(0), F.least("capacity", budget)).cast("long")).drop("left", "weights", "place", "level")


def leaf_budgets(leaves: DataFrame, fraction: float, max_epochs: int, domain_weights: dict[str, int], lang_weights: dict[str, int], source_weights: dict[str, int]) -> DataFrame:
    """Of ``leaves`` (domain, lang, source, tokens) each one's budget; the whole budget is a fraction of all tokens."""
    tree = ["domain", "lang", "source"]
    per_mille = round(fraction * 1000)
    all_domains = W.partitionBy(F.lit(0))  # a row per domain
    total = F.floor(F.sum("tokens").over(all_domains) * per_mille / 1000).cast("long")
    capacity = F.sum(F.col("tokens") * max_epochs).alias("capacity")
    level = leaves.groupBy("domain").agg(capacity, F.sum("tokens").alias("tokens")).withColumns({"weight": _weight("domain", domain_weights), "total": total})
    level = _dealt(level, [], "domain").select("domain", F.col("budget").alias("total"))
    below = leaves.groupBy("domain", "lang").agg(capacity).withColumn("weight", _weight("lang", lang_weights)).join(level, "domain")
    level = _dealt(below, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("total"))
    below = leaves.withColumns({"capacity": F.col("tokens") * max_epochs, "weight": _weight("source", source_weights)}).join(level, ["domain", "lang"])
    return _dealt(below, ["domain", "lang"], "source").select(*tree, "tokens", "budget")


def mix(
    documents: DataFrame,
    fraction: float = 0.8,
    max_epochs: int = 1,
    domain_weights: dict[str, int] | None = None,
    lang_weights: dict[str, int] | None = None,
    source_weights: dict[str, int] | None = None,
    seed: int = 20,
) -> DataFrame:
    """The selected ``documents`` with ``domain`` and ``epochs``, how often each is to be seen (at least once).

    Both columns are replaced if there already.
    """
    documents = documents.withColumn("domain", domain_of(F.col("source")))
    lang, source = F.coalesce("lang", F.lit(NONE)), F.coalesce("source", F.lit(NONE))
    stats = written(documents.select("doc_id", "domain", lang.alias("lang"), source.alias("source"), count_words(F.col("text")).alias("tokens")), "tokens")
    tree = ["domain", "lang", "source"]
    leaves = stats.groupBy(*tree).agg(F.sum("tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, fraction, max_epochs, domain_weights or {}, lang_weights or {}, source_weights or {})
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")
    plan = budgets.withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")).drop("tokens", "budget")
    plan = written(plan, "plan")

    def place(epoch: Column) -> Column:
        return F.md5(F.concat_ws("|", F.lit(seed), epoch, F.col("doc_id").cast("string")))

    # the last document of each leaf's prefix
    placed = stats.join(plan.filter("rest > 0"), tree).withColumn("place", place(F.col("whole")))
    placed = placed.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = placed.groupBy(*tree, "bucket").agg(F.sum("tokens").alias("in_bucket"))
    before = F.coalesce(F.sum("in_bucket").over(W.partitionBy(*tree).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    reached = placed.join(sums.withColumn("before", before).drop("in_bucket"), [*tree, "bucket"])
    running = F.col("before") + F.sum("tokens").over(W.partitionBy(*tree, "bucket").orderBy("place"))
    cut = reached.withColumn("running", running).filter(F.col("running") <= F.col("rest")).groupBy(*tree).agg(F.max("place").alias("cut"))
    names = fresh(documents, "_domain", "_lang", "_source", "_whole", "_cut")
    cut = written(plan.join(cut, tree, "left").select(*tree, "whole", "cut"), "cuts").toDF(*names)
    of_domain, of_lang, of_source, of_whole, of_cut = (F.col(n) for n in names)

    joined = documents.join(cut, (F.col("domain") == of_domain) & (lang == of_lang) & (source == of_source))
    epochs = of_whole + F.when(place(of_whole) <= of_cut, 1).otherwise(0)
    return joined.withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("int")).filter("epochs > 0").drop(*names)


#: Production weights.
DOMAINS = {"d0": 4, "d1": 3, "d2": 2}
LANGS = {"en": 5, "de": 2, "fr": 2}


def _sql_level(name: str, source: str, parents: list[str], child: str) -> str:
    part = f"PARTITION BY {', '.join(parents)}" if parents else ""
    order = f"ORDER BY CASE WHEN weight = 0 THEN 1 ELSE 0 END, capacity / greatest(weight, 1), {child}"
    return f"""
{name}_fill AS (
  SELECT *, total - coalesce(sum(capacity) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_before,
         sum(weight) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
         row_number() OVER ({part} {order}) AS place
  FROM {source}
), {name}_open AS (
  SELECT *, min(CASE WHEN capacity * weights > weight * rest_before THEN place END) OVER ({part}) AS first_open FROM {name}_fill
), {name}_level AS (
  SELECT *, max(CASE WHEN place = first_open THEN rest_before END) OVER ({part}) AS l, max(CASE WHEN place = first_open THEN weights END) OVER ({part}) AS w
  FROM {name}_open
), {name} AS (
  SELECT * EXCLUDE (rest_before, weights, place, first_open, l, w),
         (CASE WHEN first_open IS NULL OR place < first_open THEN capacity
               ELSE least(capacity, coalesce(floor(weight * l / nullif(w, 0)), 0)) END)::BIGINT AS budget
  FROM {name}_level
)"""


def _sql_weight(column: str, weights: dict[str, int]) -> str:
    return f"CASE {' '.join(f"WHEN {column} = '{k}' THEN {v}" for k, v in weights.items())} ELSE 1 END"


SQL = f"""
WITH stats AS (
  SELECT doc_id, CASE WHEN regexp_extract(source, '(\\d+)', 1) <> '' THEN 'd' || (regexp_extract(source, '(\\d+)', 1)::INT % 4) ELSE '(none)' END AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS tokens
  FROM documents
), leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM stats GROUP BY ALL
), total AS (SELECT floor(sum(tokens) * 800 / 1000)::BIGINT AS total FROM leaves
), domains AS (
  SELECT domain, sum(tokens)::BIGINT AS capacity, {_sql_weight("domain", DOMAINS)} AS weight, any_value(total) AS total FROM leaves, total GROUP BY domain
), {_sql_level("dealt_domains", "domains", [], "domain")}, langs AS (
  SELECT l.domain, l.lang, sum(tokens)::BIGINT AS capacity, {_sql_weight("l.lang", LANGS)} AS weight, any_value(d.budget) AS total
  FROM leaves l JOIN dealt_domains d ON l.domain = d.domain GROUP BY l.domain, l.lang
), {_sql_level("dealt_langs", "langs", ["domain"], "lang")}, sources AS (
  SELECT l.domain, l.lang, l.source, l.tokens, l.tokens AS capacity, 1 AS weight, d.budget AS total
  FROM leaves l JOIN dealt_langs d ON l.domain = d.domain AND l.lang = d.lang
), {_sql_level("dealt", "sources", ["domain", "lang"], "source")}, plan AS (
  SELECT domain, lang, source, (CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END)::INT AS whole, tokens, budget FROM dealt
), placed AS (
  SELECT s.*, p.whole, p.budget - p.whole * p.tokens AS rest, md5('20|' || p.whole || '|' || s.doc_id) AS place
  FROM stats s JOIN plan p ON s.domain = p.domain AND s.lang = p.lang AND s.source = p.source
), running AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS running FROM placed)
SELECT doc_id, domain, lang, source, (whole + CASE WHEN rest > 0 AND running <= rest THEN 1 ELSE 0 END)::INT AS epochs
FROM running WHERE whole + CASE WHEN rest > 0 AND running <= rest THEN 1 ELSE 0 END > 0
"""
