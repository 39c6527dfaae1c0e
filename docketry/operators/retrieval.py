"""Ranked retrieval: BM25 over an inverted index, cosine, fusion of ranks, trigram similarity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Parameters of the sparse vectors.
K1, B, AVERAGE_LENGTH, LONGEST_TOKEN = 1.2, 0.75, 256, 40
# English words that aren't indexed.
STOPWORDS = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits that are indexed."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)
    return F.filter(found, lambda t: ~t.isin(STOPWORDS) & (F.length(t) <= LONGEST_TOKEN))


def postings(documents: DataFrame, id: str, text: str) -> DataFrame:
    """Inverted index: token, id and the document's half of the score, from term frequency and length; all of a document is in one part."""
    placed = documents.select(id, text).repartition(id)
    counted = placed.select(id, tokens(F.col(text)).alias("t")).select(id, F.size("t").alias("len"), F.explode("t").alias("token")).groupBy(id, "token", "len").agg(F.count("*").alias("tf"))
    weight = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / AVERAGE_LENGTH))
    return counted.select("token", id, weight.alias("weight"))


def bm25(index: DataFrame, n_documents: int, queries: DataFrame, k: int, id: str, query_id: str = "query_id", text: str = "query") -> DataFrame:
    """The best ``k`` documents of each query with their scores; ties go to the smaller id.

    Scores are summed where a document's postings are, as an index that is partitioned by document keeps
    them together; only the best of each part are shuffled.  What the queries ask, each token with its
    weight, goes to all of them.
    """
    asked = queries.select(query_id, F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
    wanted = index.join(F.broadcast(asked.select("token").distinct()), "token", "left_semi")
    found_in = wanted.groupBy("token").agg(F.count("*").alias("df"))
    idf = F.log1p((n_documents - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = asked.join(found_in, "token").withColumn("idf", idf)
    scores = wanted.join(F.broadcast(weighed), "token").groupBy(query_id, id).agg(F.sum(F.col("weight") * F.col("idf")).alias("score"))
    return best(scores, query_id, id, k)


@dataclass(frozen=True)
class Index:
    """A stored inverted index: postings with their whole weights, partitioned by a hash of the token; queries read the partitions of their tokens."""

    spark: SparkSession
    path: str
    id: str
    buckets: int

    @classmethod
    def build(cls, documents: DataFrame, path: str, id: str, text: str, buckets: int = 64) -> Index:
        """Tokenise ``documents`` once and store what queries need; rows with the same id count as one document each time they have a text of its own."""
        spark = documents.sparkSession
        staged = f"{path}/postings"
        postings(documents, id, text).withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)).cast("int")).repartition("bucket", "token").sortWithinPartitions("bucket", "token").write.partitionBy("bucket").parquet(staged)
        stored = spark.read.parquet(staged)
        n = documents.count()
        # how many documents hold a token, once for all queries
        df = stored.groupBy("bucket", "token").agg(F.count("*").alias("df")).withColumn("idf", F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)))
        df.repartition("bucket").sortWithinPartitions("bucket", "token").write.partitionBy("bucket").parquet(f"{path}/tokens")
        return cls(spark, path, id, buckets)

    def search(self, queries: DataFrame, k: int, query_id: str = "query_id", text: str = "query") -> DataFrame:
        """The best ``k`` documents of each query by BM25; ties go to the smaller id."""
        asked = queries.select(query_id, F.explode(F.array_distinct(tokens(F.col(text)))).alias("token")).withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(self.buckets)).cast("int"))
        keys = ["bucket", "token"]  # the first prunes partitions
        known = self.spark.read.parquet(f"{self.path}/tokens").select(*keys, "idf")
        stored = self.spark.read.parquet(f"{self.path}/postings")
        scores = asked.join(known, keys).join(stored, keys).groupBy(query_id, self.id).agg(F.sum(F.col("weight") * F.col("idf")).alias("score"))
        return best(scores, query_id, self.id, k)


def best(scores: DataFrame, query_id: str, id: str, k: int) -> DataFrame:
    order = W.partitionBy(query_id).orderBy(F.desc(F.round("score", 9)), id)
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def fused(lists: list[DataFrame], query_id: str, id: str, k: int = 60) -> DataFrame:
    """Reciprocal rank fusion of ranked lists: the sum of 1 / (k + rank)."""
    out = lists[0].select(query_id, id, "rank")
    for other in lists[1:]:
        out = out.unionByName(other.select(query_id, id, "rank"))
    return out.groupBy(query_id, id).agg(F.sum(1 / (F.col("rank") + k)).alias("score"))


def boosted(score: Column, priority: Column) -> Column:
    return score * priority / 100


def trigrams(text: Column) -> Column:
    """Distinct three-character runs of the lower-case words, each with two blanks before and one after."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))))


def trigram_search(rows: DataFrame, queries: DataFrame, id: str, text: str, query_id: str, query: str, least: float = 0.3) -> DataFrame:
    """Pairs of queries and rows whose trigrams are similar: shared over all, at least ``least``; rows of the same id count as one.

    Equal sets of trigrams are compared once.  Of two sets that are similar enough each
    has one of the other's among its rarest trigrams, as many as it can't do without; only
    those are joined, and sets whose sizes are too far apart aren't.
    """

    def sets(rows: DataFrame, id: str, text: str) -> DataFrame:
        grams = F.array_sort(F.array_distinct(F.flatten(F.collect_list("t"))))
        return rows.select(id, trigrams(F.col(text)).alias("t")).groupBy(id).agg(grams.alias("set")).filter(F.size("set") > 0)

    asked, stored = sets(queries, query_id, query), sets(rows, id, text)
    a, b = asked.select(F.col("set").alias("a")).distinct(), stored.select(F.col("set").alias("b")).distinct()
    held = b.select(F.explode("b").alias("gram")).groupBy("gram").agg(F.count("*").alias("held"))

    def rarest(sets: DataFrame, name: str) -> DataFrame:
        # what no stored set holds is the rarest; ties go by the trigram, so that both sides have one order
        each = sets.select(name, F.explode(name).alias("gram")).join(held, "gram", "left")
        ordered = each.groupBy(name).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "gram"))).alias("grams"))
        n = F.size(name)
        # one more than the share says, as it is counted in doubles
        return ordered.select(name, F.explode(F.slice("grams", F.lit(1), F.least(n, n - F.ceil(n * least).cast("int") + 2))).alias("g")).select(name, F.col("g.gram").alias("gram"))

    near = (F.size("a") + 1 >= F.size("b") * least) & (F.size("b") + 1 >= F.size("a") * least)
    met = rarest(a, "a").join(rarest(b, "b"), "gram").filter(near).select("a", "b").distinct()
    shared = F.size(F.array_intersect("a", "b"))
    similar = met.withColumn("similarity", shared / (F.size("a") + F.size("b") - shared)).filter(F.col("similarity") >= least)
    found = asked.withColumnRenamed("set", "a").join(similar, "a").join(stored.withColumnRenamed("set", "b"), "b")
    return found.select(query_id, id, "similarity")
