"""Exact top-k inner-product search by no-random-access aggregation (NRA).

Vectors are turned into whole numbers, floor(64 * x), and rows are laid out in
blocks of similar vectors: each row goes with the nearest of some pivots, a
bounded sample, and a pivot's rows are cut into blocks.  The layout decides how
much is read, never what is found.

A block has two sorted lists per dimension, by falling and by rising value.  A
query reads the lists of its components' signs, weighted by their size, from
their heads to growing depths.  A row's score lies between bounds: what has
been read of it, plus for each list where it hasn't been met yet that list's
last value or its value read last.  Before each further read the rows whose
upper bound is below the k-th best lower bound are let go; reading stops when few
are left, and the scores of these are resolved.  Bounds and scores are
whole numbers held exactly.

Queries start with the block that they lie in.  Its k-th best score goes with
them: other blocks are visited only where the sum of the list heads of the
block's pivot reaches it, and reading there starts with that bound.  Blocks
aren't copied; the queries that need one are sent to it and pass through it in
batches.

Ties go to the smaller id.  Vectors that are null or hold null or non-finite
components take no part.  Shorter vectors count as padded with zeros.  Of rows
with the same id the one with the least vector counts.  Where bounds might not fit
64 bits they are integers of any size; only a component or a score among the results that doesn't
fit 64 bits itself is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import written

ROWS, QUERIES = 4096, 256
#: Sampled vectors around which rows are laid out, at most.
PIVOTS = 1024
DEPTHS = (1 / 16, 1 / 4, 1 / 2, 3 / 4, 1.0)
_NO_BOUND = np.iinfo(np.int64).min
#: Below every bound, if these are integers of any size.
_LEAST = -(1 << 200)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


class Lists:
    """The sorted lists of a block's rows, and NRA over them."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray) -> None:
        self.rows, self.ids = rows, ids
        both = np.concatenate([rows, -rows], 1)
        self.order = np.argsort(-both, axis=0, kind="stable").astype(np.int32)
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(rows), dtype=np.int32)[:, None], 0)
        self.largest = float(np.abs(rows).max(initial=0))
        self.both = {np.int64: both.astype(np.int64)}

    def top(self, queries: np.ndarray, query_ids: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Per query the places of its best ``k`` rows, its own and those that score below ``least`` left out, and their scores; and how many entries of its lists were read."""
        n, d = self.rows.shape
        least = np.full(len(queries), _NO_BOUND) if least is None else least
        signed = np.concatenate([np.maximum(queries, 0), np.maximum(-queries, 0)], 1)
        bound = self.largest * float(signed.max(initial=0)) * max(1, d)
        kind = np.float32 if bound < 1 << 23 else np.float64 if bound < 1 << 52 else np.int64 if bound < 1 << 61 else object
        both = self.both.setdefault(kind, self.both[np.int64].astype(kind))
        weights = np.ascontiguousarray(signed.T.astype(kind))
        lowest, heads = both.min(0), both.max(0)
        none = _LEAST if kind is object else np.iinfo(np.int64).min // 4 if kind is np.int64 else -np.inf
        floor = least.astype(kind)
        floor[least == _NO_BOUND] = none
        asking = np.flatnonzero((heads @ weights >= floor).astype(bool))  # the others have no candidate here
        read = np.zeros(len(queries), np.int64)
        alive = np.arange(n)
        survivors = np.ones((n, len(asking)), bool)
        for depth in DEPTHS if len(asking) else ():
            to = int(np.ceil(n * depth))
            read[asking] = to * d
            met = self.place[alive] < to
            values, some = both[alive], weights[:, asking]
            upper = np.where(met, values, both[self.order[to - 1], np.arange(2 * d)]) @ some
            lower = np.where(met, values, lowest) @ some
            own = self.ids[alive][:, None] == query_ids[asking][None, :]
            lower[own] = upper[own] = none
            threshold = floor[asking]
            if len(alive) >= k:
                threshold = np.maximum(threshold, np.partition(lower, len(alive) - k, axis=0)[len(alive) - k])
            survivors = (upper >= threshold).astype(bool) & ~own
            keep = survivors.any(1)
            alive, survivors = alive[keep], survivors[keep]
            if survivors.sum() <= 4 * k * len(asking):
                break
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        for j, q in enumerate(asking.tolist()):
            few = alive[survivors[:, j].astype(bool) & (self.ids[alive] != query_ids[q])]
            scores = _scores(self.rows[few], queries[q], kind is object)
            few, scores = few[scores >= least[q]], scores[scores >= least[q]]
            best = np.lexsort((self.ids[few], -scores))[:k]
            found[q] = few[best], scores[best]
        return found, read


def _scores(rows: np.ndarray, query: np.ndarray, large: bool) -> np.ndarray:
    """Inner products; sums are modulo 2**64, so they are right wherever the product itself fits."""
    if large:
        exact = rows.astype(object) @ query.astype(object)
        if any(not -(1 << 63) < x < 1 << 63 for x in exact):
            raise OverflowError("a score among the results doesn't fit 64 bits")
        return exact.astype(np.int64)
    return rows @ query


def nearest_pivot(matrix: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot at the least distance of each row."""
    m, p = matrix.astype(np.float64), pivots.astype(np.float64)
    return ((p * p).sum(1)[None, :] - 2 * m @ p.T).argmin(1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _blocks(vectors: DataFrame, width: int, rows: int, pivots: np.ndarray) -> DataFrame:
    """One row per block of ``vectors`` (id, query, vector): its pivot, ids, which of them are queries, and matrix."""

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [nearest_pivot(_matrix(batch.column(2).slice(k, 1024), width), pivots) for k in range(0, len(batch), 1024)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *near]))], names=[*batch.schema.names, "pivot"])

    def pack(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        order = np.argsort(ids)
        matrix = _matrix(group.column("vector").combine_chunks(), width)[order]
        query = group.column("query").to_numpy(zero_copy_only=False)[order]
        columns = {"pivot": group.column("pivot").slice(0, 1), "block": group.column("block").slice(0, 1)}
        for name, x in (("ids", ids[order].astype("<i8")), ("query", query), ("matrix", matrix)):
            columns[name] = pa.array([x.tobytes()], pa.binary())
        return pa.table(columns | {"head": pa.array([matrix.max(0)]), "tail": pa.array([matrix.min(0)])})

    placed = written(vectors.mapInArrow(assigned, "id long, query boolean, vector array<long>, pivot long"), "placed")
    # a row per pivot: at most PIVOTS
    shares = placed.groupBy("pivot").agg(F.ceil(F.count("*") / rows).alias("shares"))
    blocks = placed.join(F.broadcast(shares), "pivot").withColumn("block", F.pmod(F.xxhash64("id"), "shares").cast("long"))
    schema = "pivot long, block long, ids binary, query binary, matrix binary, head array<long>, tail array<long>"
    return written(blocks.groupBy("pivot", "block").applyInArrow(pack, schema), "blocks")


def visits(vectors: DataFrame, is_query: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding", rows: int = ROWS) -> DataFrame:
    """A row per query and block that it went to: query_id, ``read`` of ``entries`` list entries, and ids and scores found there."""
    whole = F.transform(F.col(vector), lambda x: F.floor(64 * x.cast("double")).cast("long"))
    good = vectors.filter(F.col(id).isNotNull() & usable(F.col(vector))).select(
        F.col(id).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), whole.alias("vector"), F.array_max(F.transform(vector, lambda x: F.abs(64 * x.cast("double")))).alias("most")
    )
    once = written(good.groupBy("id", "query").agg(F.min("vector").alias("vector"), F.max("most").alias("most")), "vectors")
    sizes = once.agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("width"), F.max("most").alias("most")).first()
    width = int(sizes.width or 0)
    if float(sizes.most or 0) >= 2.0**63:
        raise OverflowError(f"a component of {sizes.most / 64:g}: 64 times it doesn't fit 64 bits")
    once = once.drop("most")
    wanted = min(PIVOTS, -(-sizes.rows // rows)) or 1
    sample = once.orderBy(F.xxhash64("id", F.lit(7))).limit(wanted).select("vector").toArrow()
    pivots = _matrix(sample.column(0).combine_chunks(), width) if sample.num_rows else np.zeros((1, width), np.int64)
    blocks = _blocks(once, width, rows, pivots)
    found = "query_id long, read long, entries long, ids array<long>, scores array<long>"

    def result(query_ids: np.ndarray, lists: Lists, best: list, read: np.ndarray) -> list[pa.Array]:
        entries = np.full(len(query_ids), lists.rows.size, np.int64)
        kind = pa.list_(pa.int64())
        return [pa.array(query_ids), pa.array(read), pa.array(entries), pa.array([lists.ids[b].tolist() for b, _ in best], kind), pa.array([s.tolist() for _, s in best], kind)]

    names = ["query_id", "read", "entries", "ids", "scores"]

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The queries of each block against its own rows; with the k-th best score as what others must reach."""
        for batch in batches:
            for b in range(len(batch)):
                pivot, block, ids, query, matrix = (batch.column(c)[b] for c in ("pivot", "block", "ids", "query", "matrix"))
                ids = np.frombuffer(ids.as_buffer(), "<i8")
                lists = Lists(np.frombuffer(matrix.as_buffer(), "<i8").reshape(len(ids), width), ids)
                mine = np.flatnonzero(np.frombuffer(query.as_buffer(), bool))
                for at in range(0, len(mine), QUERIES):
                    some = mine[at : at + QUERIES]
                    best, read = lists.top(lists.rows[some], ids[some], k)
                    bound = [int(s[-1]) if len(s) == k else _NO_BOUND for _, s in best]
                    yield pa.RecordBatch.from_arrays(
                        [*result(ids[some], lists, best, read), pa.array([pivot.as_py()] * len(some)), pa.array([block.as_py()] * len(some)), pa.array(bound, pa.int64()), pa.array([r.tobytes() for r in lists.rows[some]], pa.binary())],
                        names=[*names, "pivot", "block", "bound", "vector"],
                    )

    home = written(blocks.mapInArrow(at_home, f"{found}, pivot long, block long, bound long, vector binary"), "home")
    # list heads of each pivot's rows: at most PIVOTS times two arrays
    ends = blocks.select("pivot", "block", F.posexplode(F.arrays_zip("head", "tail")).alias("dim", "x")).groupBy("pivot", "dim").agg(F.max("x.head").alias("head"), F.min("x.tail").alias("tail"), F.max("block").alias("last")).toPandas()
    names_of = np.unique(ends["pivot"].to_numpy(np.int64))
    head, tail, last = np.zeros((len(names_of), width)), np.zeros((len(names_of), width)), np.zeros(len(names_of), np.int64)
    row = np.searchsorted(names_of, ends["pivot"].to_numpy(np.int64))
    head[row, ends["dim"]], tail[row, ends["dim"]], last[row] = ends["head"], ends["tail"], ends["last"]

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks but its own that each query must visit; bounds are rounded up, so none is missed."""
        for batch in batches:
            for at in range(0, len(batch), 1024):
                some = batch.slice(at, 1024)
                q = np.stack([np.frombuffer(v.as_buffer(), "<i8") for v in some.column("vector")]).astype(np.float64) if width else np.zeros((len(some), 0))
                upper = np.maximum(q, 0) @ head.T + np.minimum(q, 0) @ tail.T
                bound = some.column("bound").to_numpy()
                i, p = np.nonzero((upper * (1 + 1e-9 * np.sign(upper)) + 1 >= bound[:, None]))
                n = last[p] + 1
                i, p = np.repeat(i, n), np.repeat(p, n)
                block = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
                keep = (names_of[p] != some.column("pivot").to_numpy()[i]) | (block != some.column("block").to_numpy()[i])
                i, p, block = i[keep], p[keep], block[keep]
                for k0 in range(0, len(i), 8192):
                    w = pa.array(i[k0 : k0 + 8192])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names_of[p[k0 : k0 + 8192]]), pa.array(block[k0 : k0 + 8192]), some.column("query_id").take(w), some.column("bound").take(w), some.column("vector").take(w)],
                        names=["pivot", "block", "id", "bound", "data"],
                    )

    asks = home.select("query_id", "pivot", "block", "bound", "vector").mapInArrow(others, "pivot long, block long, id long, bound long, data binary")
    stored = blocks.select("pivot", "block", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("bound"), F.col("matrix").alias("data"), "ids")
    dealt = stored.unionByName(asks.withColumn("ids", F.lit(None).cast("binary"))).repartition("pivot", "block").sortWithinPartitions("pivot", "block", F.col("id").isNotNull())

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = None
        for batch in batches:
            own = np.flatnonzero(batch.column("id").is_null().to_numpy(zero_copy_only=False))
            for start, end in zip([0, *own.tolist()], [*own.tolist(), len(batch)], strict=True):
                if start in own and end > start:
                    ids = np.frombuffer(batch.column("ids")[start].as_buffer(), "<i8")
                    lists = Lists(np.frombuffer(batch.column("data")[start].as_buffer(), "<i8").reshape(len(ids), width), ids)
                    start += 1
                for at in range(start, end, QUERIES):
                    some = batch.slice(at, min(QUERIES, end - at))
                    q = np.stack([np.frombuffer(v.as_buffer(), "<i8") for v in some.column("data")])
                    query_ids = some.column("id").to_numpy()
                    best, read = lists.top(q, query_ids, k, some.column("bound").to_numpy())
                    yield pa.RecordBatch.from_arrays(result(query_ids, lists, best, read), names=names)

    return home.select(*names).unionByName(dealt.mapInArrow(away, found))


def search(vectors: DataFrame, is_query: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding", rows: int = ROWS) -> DataFrame:
    """The ``k`` best rows (all, if fewer) of each row of ``vectors`` with ``is_query``: query_id, rank from 1, vec_id, score."""
    found = visits(vectors, is_query, k, id, vector, rows).select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.select("query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score")).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id), "score")


SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
