"""Vector code compression: product quantisation by Lloyd rounds with heaps of bounds.

A vector of whole numbers, floor(256 * x), is cut into equal parts, and each part
is replaced by the index of the nearest entry of its position's codebook.  In a
round every part goes to its nearest entry, by exact integer distance, and
every entry becomes the floor of its parts' mean.

The rows of a partition are kept in blocks.  After a scan of all entries a part
has a slack: the lower bound on its distance to any other entry minus the upper
bound on that to its own.  A block has one heap per entry, keyed by slack; when
entries move, an entry's cumulative drift (how far it went, plus the most that
another went) grows, and nothing else is touched.  The next round pops only
parts whose slack the drift since their scan has used up, scans these
exactly and pushes them anew.  All other parts can't have changed their nearest
entry, and ties are always scanned, so codes equal those of plain Lloyd rounds.

Heaps, codes and each block's sums lie in tables in the shared folder between rounds;
a round reads the last one's table and writes its own, without a shuffle of rows.  Sums
per entry are added up in Spark; only codebooks, of a fixed size, reach the driver.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .shared import join_counted, new_folder, remove, small_batches, tidy, written
from .topk import usable

#: Rows of a block, at most; bits of a row's place in it.
ROWS, ROW_BITS = 4096, 13
#: Steps of slack and drift per unit of distance, and the most that is kept of a slack.
STEPS, MOST = 1024, 1 << 44
#: Bits of the pieces in which sums that might not fit 64 bits are added up.
LIMB = 32


@dataclass(frozen=True)
class Shape:
    """Sizes, and the numbers that distances are exact in: floats, 64-bit integers, or integers of any size."""

    parts: int
    width: int  # components of a part
    stored: str  # numpy type of stored rows
    exact: str

    @classmethod
    def of(cls, parts: int, longest: int, most: float) -> Shape:
        width = max(1, -(-longest // parts))
        bound = 4.0 * most * most * max(1, width * parts)
        exact = "f8" if bound < 2.0**52 else "i8" if bound < 2.0**62 else "O"
        stored = next((t for t, top in (("<i2", 2**15), ("<i4", 2**31)) if most < top), "<i8") if exact != "O" else "<f8"
        return cls(parts, width, stored, exact)

    @property
    def limbs(self) -> int:
        """Pieces that a sum has."""
        return {"f8": 1, "i8": 2, "O": 34}[self.exact]

    @property
    def whole(self) -> type:
        """The numpy type of whole numbers."""
        return object if self.exact == "O" else np.int64

    def numbers(self, rows: np.ndarray) -> np.ndarray:
        """Stored rows as exact numbers (row, part, component)."""
        if self.exact == "O":  # stored as they came
            rows = np.array([math.floor(x * 256) if abs(x) < 2.0**900 else int(x) * 256 for x in rows.ravel().tolist()], object)
        return rows.astype(self.exact).reshape(len(rows) if rows.ndim == 2 else -1, self.parts, self.width)


def _matrix(column: pa.Array, shape: Shape) -> np.ndarray:
    """Vectors as stored rows, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), shape.parts * shape.width))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (out if shape.exact == "O" else np.floor(out * 256)).astype(shape.stored)


def scan(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row (the first, if several), and its slack in steps, rounded down."""
    d = (part * part).sum(1)[:, None] - 2 * (part @ book.T) + (book * book).sum(1)[None, :]
    near = d.argmin(1).astype(np.int64)
    slack = np.full(len(part), MOST, np.int64)
    if d.dtype == object:
        slack[:] = 0  # always scanned again
    elif len(book) > 1:
        rows = np.arange(len(part))
        first = d[rows, near]
        d[rows, near] = np.inf if d.dtype == np.float64 else np.iinfo(np.int64).max
        between = np.sqrt(d.min(1).astype(np.float64)) * (1 - 1e-12) - np.sqrt(first.astype(np.float64)) * (1 + 1e-12)
        slack = np.clip(np.floor(between * STEPS), 0, MOST).astype(np.int64)
    return near, slack


class Block:
    """Rows of a partition with the entry of each part and a heap per entry of each position."""

    def __init__(self, shape: Shape, rows: np.ndarray, entries: int) -> None:
        self.shape, self.entries, self.stored = shape, entries, rows
        self.x = shape.numbers(rows)
        self.near = np.zeros((len(rows), shape.parts), np.uint8)
        self.heaps: list[list[list[int]]] = [[[] for _ in range(entries)] for _ in range(shape.parts)]
        self.count = np.zeros((shape.parts, entries), np.int64)  # parts per entry, and their sums
        self.total = np.zeros((shape.parts, entries, shape.width), shape.whole)
        self.scanned = 0

    def assign(self, books: np.ndarray, drift: np.ndarray, all_rows: bool = False) -> None:
        """Scan the parts whose slack is used up; ``drift`` is cumulative, in steps, of each entry."""
        for p in range(self.shape.parts):
            heaps = self.heaps[p]
            if all_rows:
                popped = list(range(len(self.x)))
            else:
                popped = []
                for heap, used in zip(heaps, drift[p].tolist(), strict=True):
                    top = (used + 1 << ROW_BITS) - 1
                    while heap and heap[0] <= top:
                        popped.append(heapq.heappop(heap) & (1 << ROW_BITS) - 1)
            if not popped:
                continue
            self.scanned += len(popped)
            rows = np.array(popped)
            near, slack = scan(self.x[rows, p], books[p])
            moved = slice(None) if all_rows else np.flatnonzero(near != self.near[rows, p])
            if not all_rows:
                self._add(p, rows[moved], -1)
            self.near[rows, p] = near
            self._add(p, rows[moved], 1)
            keys = (slack + drift[p][near] << ROW_BITS) | rows
            for e, key in zip(near.tolist(), keys.tolist(), strict=True):
                heapq.heappush(heaps[e], key)

    def _add(self, p: int, rows: np.ndarray, sign: int) -> None:
        np.add.at(self.count[p], self.near[rows, p], sign)
        np.add.at(self.total[p], self.near[rows, p], sign * self.x[rows, p].astype(self.shape.whole))

    def errors(self, books: np.ndarray) -> list[int | None]:
        """Squared distance of each row to its entries; null where it doesn't fit 64 bits."""
        out = np.zeros(len(self.x), self.shape.whole)
        for p in range(self.shape.parts):
            d = self.x[:, p].astype(self.shape.whole) - books[p].astype(self.shape.whole)[self.near[:, p]]
            out = out + (d * d).sum(1)
        return [e if e < 1 << 63 else None for e in out.tolist()]

    def pack(self) -> tuple[bytes, bytes, bytes, bytes]:
        sizes = np.array([[len(h) for h in heaps] for heaps in self.heaps], "<i4")
        keys = np.array([k for heaps in self.heaps for h in heaps for k in h], "<i8")
        return self.stored.tobytes(), self.near.tobytes(), sizes.tobytes(), keys.tobytes()

    @classmethod
    def unpack(cls, shape: Shape, entries: int, rows: bytes, near: bytes, sizes: bytes, keys: bytes, counts: np.ndarray, sums: np.ndarray) -> Block:
        n = len(near) // shape.parts
        block = cls(shape, np.frombuffer(rows, shape.stored).reshape(n, shape.parts * shape.width), entries)
        block.near = np.frombuffer(near, np.uint8).reshape(n, shape.parts).copy()
        lists, at = np.frombuffer(keys, "<i8").tolist(), 0
        for p, of in enumerate(np.frombuffer(sizes, "<i4").reshape(shape.parts, entries).tolist()):
            for e, size in enumerate(of):
                block.heaps[p][e] = lists[at : at + size]
                at += size
        block.count, block.total = counts.reshape(block.count.shape).copy(), _joined(sums.reshape(*block.total.shape, shape.limbs)).astype(shape.whole)
        return block


def _limbs(total: np.ndarray, n: int) -> np.ndarray:
    """Whole numbers in ``n`` pieces of ``LIMB`` bits, the highest with the sign."""
    out, rest = [], total
    for _ in range(n - 1):
        out.append(rest & ((1 << LIMB) - 1))
        rest = rest >> LIMB
    return np.stack([*out, rest], -1).astype(np.int64)


def _joined(limbs: np.ndarray) -> np.ndarray:
    """Whole numbers from their pieces, along the last axis."""
    out = limbs[..., -1]
    for k in range(limbs.shape[-1] - 2, -1, -1):
        out = (out.astype(object) << LIMB) + limbs[..., k]
    return out


def drifted(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Steps that each entry went plus the most that another of its position went, rounded up."""
    went = np.array([[math.sqrt(min(sum(int(x) ** 2 for x in d), 1 << 1000)) for d in part] for part in after.astype(object) - before.astype(object)])
    out = np.zeros(went.shape, np.int64)
    for p, part in enumerate(went):
        for e, own in enumerate(part):
            others = max((x for k, x in enumerate(part) if k != e), default=0.0)
            out[p, e] = min(math.ceil((own + others) * (1 + 1e-12) * STEPS), MOST)
    return out


@dataclass(frozen=True)
class Codes:
    """``rows`` (id, label, ``code``, ``error``), a written table, and the codebooks by part, entry and component."""

    rows: DataFrame
    codebooks: list[list[list[int]]]
    scanned: list[int]  # parts scanned in each round

    @property
    def sha256(self) -> str:
        return sha256(",".join(str(x) for part in self.codebooks for entry in part for x in entry).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id: str = "vec_id", vector: str = "embedding", label: str = "label", rows: int = ROWS) -> Codes:
    """Codes of all ``vectors`` whose vector is there and whole, in ``rounds`` rounds from the vectors of the smallest ids.

    Rows with a null vector, or null or non-finite components, are dropped.  Repeated
    rows stay and count each.  Of equal ids the lesser vector comes first; null ids come
    last.  If there are fewer rows than entries, the codebooks have as many entries as rows.
    Vectors shorter than the longest, or than a multiple of ``parts``, count as
    padded with zeros, to one component a part at least.  Of equally near entries the first is taken.  Numbers of any size
    are exact; an error that doesn't fit 64 bits is null.  An empty table gives an empty one.
    """
    if not 0 < entries <= 256 or rows > 1 << ROW_BITS - 1:
        raise ValueError("a code has up to 256 entries, a block up to 4096 rows")
    spark = vectors.sparkSession
    small_batches(spark)
    kinds = {"id": vectors.schema[id].dataType, "label": vectors.schema[label].dataType}
    good = vectors.filter(usable(F.col(vector))).select(F.col(id).alias("id"), F.col(label).alias("label"), F.transform(vector, lambda x: x.cast("double")).alias("vector"))
    top = F.array_max(F.transform("vector", lambda x: F.abs(256 * x)))
    found = good.agg(F.max(F.size("vector")).alias("longest"), F.max(top).alias("most")).first()
    shape = Shape.of(parts, int(found.longest or 0), float(found.most or 0) + 1)
    smallest = good.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").toArrow()
    first = _matrix(smallest.column(0).combine_chunks(), shape) if smallest.num_rows else np.zeros((0, parts * shape.width), shape.stored)
    books = np.ascontiguousarray(shape.numbers(first).transpose(1, 0, 2))
    n = books.shape[1]
    drift = np.zeros((parts, n), np.int64)

    state = StructType([StructField("ids", ArrayType(kinds["id"])), StructField("labels", ArrayType(kinds["label"])), *(StructField(x, BinaryType()) for x in ("rows", "near", "sizes", "keys")), StructField("scanned", LongType())])
    state.add("counts", ArrayType(LongType())).add("sums", ArrayType(LongType()))

    def record(ids: pa.Array, labels: pa.Array, block: Block) -> pa.RecordBatch:
        columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, labels)] + [pa.array([x], pa.binary()) for x in block.pack()]
        columns += [pa.array([block.scanned]), pa.array([block.count.ravel()]), pa.array([_limbs(block.total, shape.limbs).ravel()])]
        return pa.RecordBatch.from_arrays(columns, names=state.fieldNames())

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                some = batch.slice(at, rows)
                block = Block(shape, _matrix(some.column("vector"), shape), n)
                block.assign(books, drift, all_rows=True)
                yield record(some.column("id"), some.column("label"), block)

    def blocks(batches: Iterator[pa.RecordBatch], books: np.ndarray, drift: np.ndarray) -> Iterator[tuple[pa.Array, pa.Array, Block]]:
        for batch in batches:
            for k in range(len(batch)):
                stored = (batch.column(c)[k].as_buffer() for c in ("rows", "near", "sizes", "keys"))
                block = Block.unpack(shape, n, *stored, *(batch.column(c)[k].values.to_numpy() for c in ("counts", "sums")))
                block.assign(books, drift)
                yield batch.column("ids")[k].values, batch.column("labels")[k].values, block

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's sums: one row per position and entry."""
        count, total = np.zeros(parts * n, np.int64), np.zeros(parts * n * shape.width * shape.limbs, np.int64)
        for batch in batches:
            for c, s in zip(batch.column("counts"), batch.column("sums"), strict=True):
                count += c.values.to_numpy()
                total += s.values.to_numpy()
        used = np.flatnonzero(count)
        sums = total.reshape(len(count), -1)[used]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), pa.array(list(sums), pa.list_(pa.int64()))], names=["entry", "count", "sums"])

    def moved(states: DataFrame) -> np.ndarray:
        """The codebooks after a round: parts x entries rows of sums come to the driver."""
        pieces = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(shape.width * shape.limbs)]
        per_entry = states.select("counts", "sums").mapInArrow(summed, "entry long, count long, sums array<long>").groupBy("entry").agg(F.sum("count").alias("count"), *pieces)
        after = books.astype(object).reshape(parts * n, shape.width)
        for r in per_entry.collect():
            after[r["entry"]] = [int(x) // r["count"] for x in _joined(np.array(r[2:], object).reshape(shape.width, shape.limbs))]
        return after.reshape(parts, n, shape.width).astype(shape.exact)

    def work_of(books: np.ndarray, drift: np.ndarray):
        def later_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, labels, block in blocks(batches, books, drift):
                yield record(ids, labels, block)

        return later_round

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, block in blocks(batches, books, drift):
            codes = [x.tobytes().hex() for x in block.near]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes, pa.string()), pa.array(block.errors(books), pa.int64())], names=["id", "label", "code", "error"])

    path, scanned, frame = "", [], good.mapInArrow(tidy(first_round), state)
    for _ in range(max(1, rounds)):
        before, path = path, new_folder(spark, "vector-blocks")
        frame.write.parquet(path)
        states = spark.read.schema(state).parquet(path)
        if before:
            remove(spark, before)
        scanned.append(states.agg(F.sum("scanned")).first()[0] or 0)
        after = moved(states) if n and rounds else books
        drift, books = drift + drifted(books, after), after
        frame = states.mapInArrow(tidy(work_of(books, drift)), state)
    out = StructType([StructField("id", kinds["id"]), StructField("label", kinds["label"]), StructField("code", StringType()), StructField("error", LongType())])
    done = written(states.mapInArrow(tidy(last), out), "vector-codes")
    remove(spark, path)
    return Codes(done.select(F.col("id").alias(id), F.col("label").alias(label), "code", "error"), [[[int(x) for x in entry] for entry in part] for part in books], scanned)


def with_label_errors(codes: DataFrame, label: str = "label") -> DataFrame:
    """``codes`` with ``label_error``, the errors summed over equal labels, nulls together; null where a sum holds a null or doesn't fit 64 bits."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    keyed = codes.withColumns({"_null": F.col(label).isNull(), "_label": F.coalesce(F.col(label).cast("string"), F.lit(""))})
    sums = keyed.groupBy("_null", "_label").agg(F.count("*").alias("c"), F.when(F.count("error") == F.count("*"), total.try_cast("long")).alias("label_error"))
    sums = written(sums, "label-errors")
    return join_counted(keyed, sums, ["_null", "_label"], codes.count()).drop("_null", "_label", "c")


SQL = """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) t(p)
), b0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64
), a1 AS (SELECT r, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + e) % 64 AS e FROM parts JOIN b0 USING (p) GROUP BY r, p
), s1 AS (SELECT p, e, k, floor(sum(x[k])::DOUBLE / count(*))::BIGINT AS m FROM parts JOIN a1 USING (r, p), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS k) GROUP BY p, e, k
), b1 AS (SELECT p, e, coalesce(m, c) AS c FROM b0 LEFT JOIN (SELECT p, e, list(m ORDER BY k) AS m FROM s1 GROUP BY p, e) USING (p, e)
), a2 AS (SELECT r, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + e) % 64 AS e FROM parts JOIN b1 USING (p) GROUP BY r, p
), s2 AS (SELECT p, e, k, floor(sum(x[k])::DOUBLE / count(*))::BIGINT AS m FROM parts JOIN a2 USING (r, p), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS k) GROUP BY p, e, k
), b2 AS (SELECT p, e, coalesce(m, c) AS c FROM b1 LEFT JOIN (SELECT p, e, list(m ORDER BY k) AS m FROM s2 GROUP BY p, e) USING (p, e)
), a3 AS (SELECT r, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + e) AS de FROM parts JOIN b2 USING (p) GROUP BY r, p
), coded AS (SELECT r, string_agg(printf('%02x', de % 64), '' ORDER BY p) AS code, sum(de // 64)::BIGINT AS error FROM a3 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""
