"""N-gram Jaccard join by a token-group matrix.

A document's set holds the 64-bit hashes of its distinct word shingles; two
documents link when ``100 * |intersection| >= percent * |union|``.  The result
is exact up to collisions of 64-bit hashes.

1. All shingles are counted into sorted hash arrays (those found twice or
   more), and each set is ordered from rare to common.  Documents with equal
   sets are one class and go on as its smallest id.
2. Sets that link share a token among the first few of their order; only such
   tokens that occur twice are joined on.
3. Every token's holders are held against its smallest holder alone, which is
   a linear number of pairs.  Links found so far make clusters.
4. Each cluster is cut into groups of some 32 similar documents.  A group's row
   of the matrix is the union of its members' tokens.  Documents of other
   clusters that share a token with a group bound their overlap with any member
   by the overlap with this union; only groups that qualify are opened, and
   their members compared exactly.

Pairs within a cluster are never compared again: they are connected already.
Candidates of a much-wanted group are split over tasks, each with a copy of the
group.  Null and empty texts, and texts without words, link with nothing; rows
with the same doc_id count as one document; null ids link with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hasharrays as ha
from . import textarrays as ta
from .shared import components, new_folder, small_batches, tidy, written

GROUP = 32
#: Candidates of one group that a task compares with it.
SHARE = 512


def _signatures(texts: DataFrame, kind: str, width: int, percent: int) -> DataFrame:
    """Per row: id, set size, two fingerprints, tokens to join on with their places, and the set if there are any."""
    spark = texts.sparkSession
    folder, bits = new_folder(spark, "shingles"), ha.bucket_bits(spark)

    def bucket_of(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - bits)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ha.Counter(bucket_of)
        for batch in batches:
            for _, _, data, offsets in ta.parts(batch.column(0)):
                yield from counter.add(ta.shingle_hashes(*ta.word_hashes(data, offsets), width)[0])
        yield from counter.flush()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys, counts in ha.by_bucket(batches):
            twice = counts > 1
            ha.put(folder, f"s{bucket:06d}", {"keys": keys[twice], "counts": ha._narrow(counts[twice])})
            yield pa.RecordBatch.from_pydict({"n": [int(twice.sum())]})

    ha.merged(texts.select("text").mapInArrow(tidy(count), ha.BLOBS), 1 << bits).mapInArrow(tidy(write), "n long").agg(F.sum("n")).collect()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in ta.parts(batch.column(1)):
                h, bounds = ta.shingle_hashes(*ta.word_hashes(data, offsets), width)
                size = np.diff(bounds)
                unique, inverse = np.unique(h, return_inverse=True)
                _, found = ha.lookup(folder, "s", bucket_of(unique), unique, ("counts",))
                owner = np.repeat(np.arange(len(size)), size)
                count = found.astype(np.int64)[inverse]
                order = np.lexsort((h, count, owner))
                place = np.arange(len(h)) - bounds[owner]
                probe = size - -(-size * percent // 100) + 1
                use = (place < probe[owner]) & (count[order] > 1)
                shared = np.bincount(owner[use], minlength=len(size))
                mixed = ta.mix(h)
                pad = np.append(mixed, np.uint64(0))
                at = np.minimum(bounds[:-1], len(h))
                f1 = np.where(size > 0, np.add.reduceat(pad, at), 0).astype(np.int64)
                f2 = np.where(size > 0, np.bitwise_xor.reduceat(np.append(ta.mix(mixed), np.uint64(0)), at), 0).astype(np.int64)
                lists = np.concatenate([[0], np.cumsum(shared)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(size),
                        pa.array(f1),
                        pa.array(f2),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(h[order][use].astype(np.int64))),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(place[use].astype(np.int32))),
                        pa.array([h[a:b].tobytes() if k else None for a, b, k in zip(bounds.tolist(), bounds[1:].tolist(), shared.tolist(), strict=False)], pa.binary()),
                    ],
                    names=["id", "n", "f1", "f2", "tokens", "places", "set"],
                )

    return written(texts.mapInArrow(tidy(sign), f"id {kind}, n long, f1 long, f2 long, tokens array<long>, places array<int>, set binary"), "signatures")


def _opened(candidates: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (src, dst) between ``candidates`` (x, g) and the ``members`` (g, m) of the groups they name."""
    wanted = candidates.groupBy("g").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    whose = members.join(wanted, "g").join(sets.withColumnRenamed("id", "m"), "m")
    whose = whose.select("g", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), F.col("m").alias("id"), "n", "set")
    asking = candidates.join(wanted, "g").join(sets.withColumnRenamed("id", "x"), "x")
    asking = asking.select("g", F.pmod(F.xxhash64("x", F.lit(9)), "shares").cast("int").alias("share"), F.lit(1).alias("kind"), F.col("x").alias("id"), "n", "set")
    dealt = whose.unionByName(asking).repartition("g", "share").sortWithinPartitions("g", "share", "kind")
    kind = sets.schema["id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, union, least, most = None, [], np.zeros(0, np.uint64), 0, 0
        for batch in batches:
            src, dst = [], []
            for g, share, role, i, n, raw in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                tokens = np.frombuffer(raw, np.uint64)
                if (g, share) != now:
                    now, group, union = (g, share), [], None
                if role == 0:
                    group.append((i, n, tokens))
                    continue
                if union is None:
                    union = np.unique(np.concatenate([t for _, _, t in group])) if len(group) > 1 else group[0][2] if group else np.zeros(0, np.uint64)
                    least, most = min((m for _, m, _ in group), default=0), max((m for _, m, _ in group), default=0)
                smallest = max(least, -(-n * percent // 100))
                if not group or most * 100 < percent * n:
                    continue
                if len(group) > 1 and (100 + percent) * _common(tokens, union) < percent * (n + smallest):
                    continue  # no member can overlap enough
                for m, size, other in group:
                    if m != i and 100 * min(n, size) >= percent * max(n, size) and (100 + percent) * _common(tokens, other) >= percent * (n + size):
                        src.append(i)
                        dst.append(m)
            yield pa.RecordBatch.from_arrays([pa.array(src, batch.column(3).type), pa.array(dst, batch.column(3).type)], names=["src", "dst"])

    return dealt.mapInArrow(tidy(compare), f"src {kind}, dst {kind}")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays without repetitions share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def join(documents: DataFrame, width: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``documents``: its id, ``n_shingles``, and ``component_id``, the smallest id reachable by links."""
    small_batches(documents.sparkSession)
    kind = documents.schema[id].dataType.simpleString()
    texts = documents.select(F.col(id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    signed = _signatures(texts, kind, width, percent)
    full = signed.filter("n > 0 and id is not null")
    classes = written(full.groupBy("f1", "f2", "n").agg(F.min("id").alias("rep")), "classes")
    reps = full.join(classes.select("f1", "f2", "n", F.col("rep").alias("id")), ["f1", "f2", "n", "id"], "left_semi").filter("set is not null")
    sets = reps.select("id", "n", "set")

    index_size = F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + 1
    tokens = written(
        reps.select("id", "n", F.explode(F.arrays_zip("tokens", "places")).alias("t")).select("id", "n", F.col("t.tokens").alias("token"), (F.col("t.places") < index_size).alias("indexed")),
        "tokens",
    )
    close = (F.col("n") * 100 >= percent * F.col("least")) & (F.col("most") * 100 >= percent * F.col("n"))

    # everyone against the smallest holder of each of its tokens
    first = tokens.groupBy("token").agg(F.min(F.struct("id", "n")).alias("first"), F.max("id").alias("last")).filter("first.id <> last")
    first = first.select("token", F.col("first.id").alias("g"), F.col("first.n").alias("least"), F.col("first.n").alias("most"))
    stars = tokens.join(first, "token").filter((F.col("id") != F.col("g")) & close).select(F.col("id").alias("x"), "g").distinct()
    stars = written(stars, "stars")
    links = written(_opened(stars, stars.select("g").distinct().withColumn("m", F.col("g")), sets, percent).distinct(), "links")
    labels = components(links)

    # the rest against the groups of other clusters
    labelled = tokens.join(labels.withColumnRenamed("component", "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("token")
    labelled = written(labelled.join(mixed, "token", "left_semi"), "mixed-tokens")
    sizes = labelled.select("label", "id").distinct().groupBy("label").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    member = F.xxhash64("label", F.pmod(F.xxhash64("id", F.lit(3)), "groups")).alias("g")
    grouped = labelled.filter("indexed").join(sizes, "label").select("token", "label", "id", "n", member)
    rows = grouped.groupBy("token", "g").agg(F.min("label").alias("theirs"), F.max("label").alias("also"), F.min("n").alias("least"), F.max("n").alias("most"))
    outside = (F.col("label") != F.col("theirs")) | (F.col("theirs") != F.col("also"))
    asked = labelled.join(rows, "token").filter(outside & close & (F.col("least") <= F.col("n"))).select(F.col("id").alias("x"), "g").distinct()
    asked = written(asked, "asked")
    members = grouped.select("g", F.col("id").alias("m")).distinct()
    more = written(_opened(asked, members, sets, percent).distinct(), "more-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    placed = signed.select("id", "n", "f1", "f2").join(classes, ["f1", "f2", "n"], "left").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("id").isNull() | (F.col("n") == 0), F.col("id")).otherwise(F.coalesce("component", "rep"))
    return placed.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"))
