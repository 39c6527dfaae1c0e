"""The citation graph from texts: aliases that cases give themselves, nodes with stubs, edges grown batch by batch, stubs resolved by search."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import extract
from . import retrieval

# How a case says where it is reported, tried in this order, with the form that the groups are written in.
SELF_REFERENCES = [
    (r"(?i)reported\s+(?:in|as)\s+\((\d{4})\)\s+(\d+)\s+SCC\s+(\d+)", "(%1$s) %2$s SCC %3$s", 3),
    (r"(?i)reported\s+(?:in|as)\s+AIR\s+(\d{4})\s+SC\s+(\d+)", "AIR %1$s SC %2$s", 2),
    (r"(?i)\(\s*reported\s+(?:in|as)\s+\((\d{4})\)\s+(\d+)\s+SCC\s+(\d+)\s*\)", "(%1$s) %2$s SCC %3$s", 3),
    (r"(?i)cited\s+as\s+\((\d{4})\)\s+(\d+)\s+SCC\s+(\d+)", "(%1$s) %2$s SCC %3$s", 3),
]
#: Years by which an alias and a case may differ, and a stub and what resolves it; how many hits of a stub are looked at.
ALIAS_YEARS, STUB_YEARS, STUB_HITS = 1, 2, 5
# Names of two parties in running text, years that citations can have, and other names of courts.
CASE_NAME = r"(?i)(?:In\s+)?(?:Re:\s*)?([A-Z][a-zA-Z\s&.,]+?)\s+(?:v\.?|vs\.?|versus)\s+([A-Z][a-zA-Z\s&.,]+?)(?=\s*[\[(,]|\s+\d{4}|\s*$)"
FIRST_YEAR, LAST_YEAR = 1860, 2100
COURT_CODES = {
    "SUPREME COURT": "SC", "DELHI": "DEL", "BOMBAY": "BOM", "MUMBAI": "BOM", "MADRAS": "MAD", "CHENNAI": "MAD", "CALCUTTA": "CAL", "KOLKATA": "CAL", "KARNATAKA": "KAR", "BENGALURU": "KAR", "BANGALORE": "KAR",
}


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode normal form KC; Spark has no built-in for it."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def stub_key(citation: Column) -> Column:
    """A citation as stubs are matched: compatibility forms, upper case, no white space around dots and within parentheses."""
    out = F.upper(F.trim(F.regexp_replace(nfkc(citation), r"(?U)\s+", " ")))
    for pattern, replacement in ((r"\s*\.\s*", "."), (r"\(\s+", "("), (r"\s+\)", ")")):
        out = F.regexp_replace(out, pattern, replacement)
    return out


def scc_year(citation: Column) -> Column:
    """The year in parentheses that a citation begins with; null without one."""
    return F.regexp_extract(citation, r"\((\d{4})\)", 1).try_cast("int")


def valid_year(year: Column) -> Column:
    return F.coalesce(year.between(FIRST_YEAR, LAST_YEAR), F.lit(False))


def court_code(code: Column) -> Column:
    """A court's code in upper case, other names under the code they stand for."""
    upper = F.upper(F.trim(code))
    names = F.create_map(*(F.lit(x) for pair in COURT_CODES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, upper), upper)


def case_names(text: Column) -> Column:
    """An array of structs (first, second) of the parties named in running text."""
    first, second = (F.regexp_extract_all(text, F.lit(CASE_NAME), F.lit(g)) for g in (1, 2))
    return F.zip_with(first, second, lambda a, b: F.struct(F.trim(a).alias("first"), F.trim(b).alias("second")))


def self_reference(text: Column, year: Column) -> Column:
    """The first citation that a text gives itself within a year of the case's, if that is known; null without one."""

    def of(pattern: str, form: str, groups: int) -> Column:
        def written(hit: Column) -> Column:
            parts = [F.regexp_extract(hit, pattern, g) for g in range(1, groups + 1)]
            near = F.coalesce(F.abs(parts[0].try_cast("int") - year) <= ALIAS_YEARS, F.lit(True)) | (year == 0)
            return F.when(near, F.format_string(form, *parts))

        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), written)

    searched = F.filter(F.concat(*(of(*x) for x in SELF_REFERENCES)), lambda x: x.isNotNull())
    lower = F.lower(text)
    return F.when(lower.contains("reported") | lower.contains("cited"), F.get(searched, F.lit(0)))


def mined_aliases(chunks: DataFrame, case: str = "case_id", order: str = "chunk_index", text: str = "text", year: str = "year") -> DataFrame:
    """One alias per case that gives one: the first of its first chunk that does, with ``normalized`` and ``citation_type``."""
    found = chunks.select(case, order, self_reference(F.col(text), F.col(year)).alias("alias")).filter("alias is not null")
    first = found.groupBy(case).agg(F.min_by("alias", F.struct(order, "alias")).alias("alias"))
    return first.select(case, "alias", extract.alias_key(F.col("alias")).alias("normalized"), extract.citation_type(F.col("alias")).alias("citation_type"))


def known_aliases(aliases: DataFrame, cases: DataFrame, case: str = "case_id", corpus_id: str = "corpus_case_id") -> DataFrame:
    """Aliases of cases that are known, with these cases' columns; of a normalized alias the one of the smallest case stays."""
    joined = aliases.join(cases.withColumnRenamed(corpus_id, case), case)
    first = W.partitionBy("normalized").orderBy(case)
    return joined.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def node_id(key: Column) -> Column:
    """The id of a node by its normalized citation; the same in every run."""
    digest = F.md5(key)
    return F.concat_ws("-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def grown(cited: DataFrame, nodes: DataFrame, edges: DataFrame, key: Callable[[Column], Column] = extract.graph_key) -> tuple[DataFrame, DataFrame]:
    """New nodes and edges that ``cited`` (citing, raw) adds to a graph of ``nodes`` (id, key) and ``edges`` (citing, cited).

    A citation that no node has makes a stub (id, key, raw), ``raw`` its smallest form.
    Edges to itself and those that are there already are left out.
    """
    keyed = cited.select("citing", "raw", key(F.col("raw")).alias("key")).filter("key <> ''").distinct()
    known = nodes.groupBy("key").agg(F.min("id").alias("id"))
    stubs = keyed.groupBy("key").agg(F.min("raw").alias("raw")).join(known, "key", "left_anti").select(node_id(F.col("key")).alias("id"), "key", "raw")
    ids = known.unionByName(stubs.select("key", "id"))
    found = keyed.join(ids, "key").select("citing", F.col("id").alias("cited")).filter("citing <> cited").distinct()
    return stubs, found.join(edges.select("citing", "cited"), ["citing", "cited"], "left_anti")


def grow(spark: SparkSession, path: str, batch: str, cited: DataFrame, nodes: DataFrame) -> int:
    """Add a batch to the graph stored under ``path``; how many edges it has.

    A batch has a partition of its own, which a repeated run writes again, and is
    resumed after the last one whose mark is there: with a mark it is left as it is.
    ``nodes`` are those known from elsewhere; stubs and edges of other batches count as known.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()

    def exists(name: str) -> bool:
        at = fs.Path(f"{path}/{name}")
        return at.getFileSystem(conf).exists(at)

    def earlier(name: str, schema: str) -> DataFrame:
        if not exists(name):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema + ", batch string").parquet(f"{path}/{name}").filter(F.col("batch") != batch).drop("batch")

    if not exists(f"marks/{batch}"):
        stubs, edges = grown(cited, nodes.select("id", "key").unionByName(earlier("nodes", "id string, key string, raw string").select("id", "key")), earlier("edges", "citing string, cited string"))
        for name, rows in (("nodes", stubs), ("edges", edges)):
            rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{path}/{name}")
        mark = fs.Path(f"{path}/marks/{batch}")
        mark.getFileSystem(conf).mkdirs(mark)
    return spark.read.schema("citing string, cited string, batch string").parquet(f"{path}/edges").filter(F.col("batch") == batch).count()


def resolved_stubs(stubs: DataFrame, index: retrieval.Index, cases: DataFrame, aliases: DataFrame) -> DataFrame:
    """Stubs (citation) that a search finds: citation, ``normalized``, case_id, rank and score of the first hit that will do.

    Of a stub's best hits the first counts that is among ``cases`` (case_id, year) with a year
    near the citation's, where both are known.  Stubs whose citation is among ``aliases`` (normalized)
    are left out.
    """
    asked = stubs.select("citation").distinct().withColumn("normalized", stub_key(F.col("citation"))).join(aliases.select("normalized"), "normalized", "left_anti")
    hits = index.search(asked.select(F.col("citation").alias("query_id"), F.col("citation").alias("query")), STUB_HITS)
    found = hits.join(cases.select("case_id", "year"), "case_id").withColumn("wanted", scc_year(F.col("query_id")))
    near = found.filter(F.coalesce((F.abs(F.col("wanted") - F.col("year")) <= STUB_YEARS) | (F.col("year") == 0), F.lit(True)))
    first = near.groupBy("query_id").agg(F.min_by(F.struct("case_id", "rank", "score"), "rank").alias("h"))
    return first.join(asked, F.col("query_id") == F.col("citation")).select("citation", "normalized", "h.case_id", "h.rank", "h.score")
