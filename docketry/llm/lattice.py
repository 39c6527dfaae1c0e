"""Embedding near-dedup by lattice hashing.

Vectors of equal label are linked when their cosine, in double precision, is at
least the threshold.  Unit vectors are projected to eight dimensions by seeded
random orthonormal maps, one per table, and decoded to the nearest point of the
E8 lattice, their cell.  A vector is stored under its cell and probes those
neighbouring cells that lie nearest to it.  Vectors that meet in any table are
candidates, and each candidate's cosine is verified, so all links are true;
some may be missed.  Recall against brute force is above 0.9 (see the tests).
Links are counted where vectors meet; no table of pairs is made.

Equal vectors of a label are hashed once, as one class; they count as linked
with each other.  Vectors that are null, zero or hold null or non-finite
components, and vectors of null label, link with nothing.  Vectors of different
lengths aren't compared.  Rows with the same id and vector count as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .shared import components, join_counted, small_batches, tidy, written
from .topk import usable

TABLES = 6
PROBES = 12
#: Lattice units per unit of length: at a cosine of 0.93 six tables and twelve probes still find 99 pairs of 100.
SCALE = 8.0
#: Of a cell, so many stored and probing vectors are compared in one place.
STORED, PROBING = 1024, 16_384


@lru_cache(1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if s.count(-1.0) % 2 == 0]
    return np.stack(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(1) % 2 != 0)
    error = x[odd] - r[odd]
    worst = np.abs(error).argmax(1)
    r[odd, worst] += np.where(error[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: D8, or D8 moved by a half in all coordinates."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


@lru_cache(64)
def projection(dim: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([8, dim, table])
    q, _ = np.linalg.qr(rng.normal(size=(max(dim, 8), 8)))
    return q[:dim] * SCALE * np.sqrt(max(dim, 8) / 64), rng.uniform(0, 2, 8)


def _cell_key(cells: np.ndarray, table: int) -> np.ndarray:
    h = np.full(len(cells), table + 1, np.uint64)
    for k in range(8):
        h = ta.mix(h * np.uint64(0x9E3779B97F4A7C15) + (2 * cells[:, k]).astype(np.int64).astype(np.uint64))
    return h.astype(np.int64)


def cells(unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each vector's cell, and of its cell and the neighbours it probes: (n), (n, 1 + PROBES)."""
    p, shift = projection(unit.shape[1], table)
    x = unit @ p + shift
    home = nearest_e8(x)
    near = np.argpartition(-(x - home) @ neighbours().T, PROBES, axis=1)[:, :PROBES]
    own = _cell_key(home, table)
    probed = [_cell_key(home + neighbours()[near[:, k]], table) for k in range(PROBES)]
    return own, np.stack([own, *probed], 1)


def signature(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of unit vectors in all tables: where each is stored (n, TABLES), and what it probes (n, TABLES, 1 + PROBES)."""
    own, probed = zip(*(cells(unit, table) for table in range(TABLES)), strict=True)
    return np.stack(own, 1) ^ unit.shape[1], np.stack(probed, 1) ^ unit.shape[1]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n places the smallest that the pairs (i, j) connect it with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _linked(key: np.ndarray, stored: np.ndarray, unit: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i stored, j probing) of linked rows; rows are sorted by ``key``, those stored first."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = np.append(starts[1:], len(key))
    n_stored = np.add.reduceat(stored.astype(np.int64), starts)
    i, j = [], []
    small = n_stored * (ends - starts - n_stored) < 256
    # small cells all at once
    first, many = np.repeat(np.where(small, starts, 0), ends - starts), np.repeat(np.where(small, n_stored, 0), ends - starts)
    probing = np.flatnonzero(~stored & (many > 0))
    many, first = many[probing], first[probing]
    b = np.repeat(probing, many)
    a = np.repeat(first - np.cumsum(many) + many, many) + np.arange(len(b))
    for k in range(0, len(a), 1 << 16):
        x, y = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
        hit = np.einsum("nd,nd->n", unit[x], unit[y]) >= threshold
        i.append(x[hit])
        j.append(y[hit])
    for s, e, n in zip(starts[~small].tolist(), ends[~small].tolist(), n_stored[~small].tolist(), strict=True):
        x, y = np.nonzero(unit[s : s + n] @ unit[s + n : e].T >= threshold)
        i.append(x + s)
        j.append(y + s + n)
    return np.concatenate([np.zeros(0, np.int64), *i]), np.concatenate([np.zeros(0, np.int64), *j])


def _first_meeting(own: np.ndarray, probed: np.ndarray, cell: np.ndarray, ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether each pair (i stored, j probing) meets nowhere before this cell: by table, and the smaller id stored first."""
    out = np.empty(len(i), bool)
    for k in range(0, len(i), 1 << 15):
        a, b = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
        table = (own[a] == cell[a][:, None]).argmax(1)
        swapped = ids[a] > ids[b]
        before = np.zeros(len(a), bool)
        for t in range(TABLES):
            ab = (own[a, t][:, None] == probed[b, t]).any(1)
            ba = (own[b, t][:, None] == probed[a, t]).any(1)
            before |= np.where(t < table, ab | ba, (t == table) & swapped & ba)
        out[k : k + (1 << 15)] = ~before
    return out


def links(classes: DataFrame, threshold: float) -> DataFrame:
    """What links tell of ``classes`` (id, label, vector, copies): rows of an id, ``n`` vectors linked with it, and ``root``, an id that it is connected with.

    Vectors that meet in a cell are compared there, in blocks of ``STORED`` by
    ``PROBING``; a pair that meets in several cells is counted in the first.
    No pair leaves its task: only sums, and a forest of what is connected.
    """
    spark = classes.sparkSession
    small_batches(spark)
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}

    def units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Unit vectors, padded with zeros, and their lengths."""
        sizes = np.diff(column.offsets.to_numpy())
        out = np.zeros((len(sizes), int(sizes.max(initial=0))))
        out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = column.flatten().to_numpy()
        return out / np.linalg.norm(out, axis=1, keepdims=True), sizes

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, sizes = units(batch.column(2))
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                own, probed = signature(unit[rows, :dim])
                at = pa.array(np.concatenate([np.repeat(rows, TABLES), np.repeat(rows, TABLES * (1 + PROBES))]))
                stored = np.zeros(len(at), bool)
                stored[: own.size] = True
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate([own.ravel(), probed.ravel()])), pa.array(stored)],
                    names=["id", "label", "cell", "stored"],
                )

    keys = written(classes.select("id", "label", "vector").mapInArrow(hashed, f"id {kinds['id']}, label {kinds['label']}, cell long, stored boolean"), "cells")
    counted = keys.groupBy("label", "cell").agg(F.count("*").alias("c"), F.count_if("stored").alias("s"), F.min("id").alias("low"), F.max("id").alias("high")).filter("s > 0 and low <> high")
    counted = counted.select("label", "cell", "c", F.ceil(F.col("s") / STORED).cast("int").alias("across"), F.ceil((F.col("c") - F.col("s")) / PROBING).cast("int").alias("down"))
    met = join_counted(keys, written(counted, "shared-cells"), ["label", "cell"], keys.count())

    def one(n: str, seed: int) -> Column:
        return F.array(F.pmod(F.xxhash64("id", F.lit(seed)), n).cast("int"))

    def each(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    met = met.withColumn("x", F.explode(F.when(F.col("stored"), one("across", 11)).otherwise(each("across")))).withColumn("y", F.explode(F.when(F.col("stored"), each("down")).otherwise(one("down", 12))))
    # a row's place: its share of a cell
    met = met.select("cell", F.xxhash64("label", "cell", "x", "y").alias("share"), "stored", "id").join(classes.select("id", "copies", "vector"), "id")
    dealt = met.select("share", "cell", "stored", "id", "copies", "vector").repartition("share").sortWithinPartitions("share", F.desc("stored"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            table = batch if carried is None else pa.concat_batches([carried, batch])
            share, stored = table.column("share").to_numpy(), table.column("stored").to_numpy(zero_copy_only=False)
            carried = table.filter(pa.array(stored & (share == share[-1])))  # for the rest of the last share
            new = np.arange(len(table)) >= len(table) - len(batch)
            unit, sizes = units(table.column("vector"))
            i, j = _linked(share, stored, unit, threshold)
            ids = table.column("id").to_numpy()
            keep = (ids[i] != ids[j]) & new[j]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            rows = np.unique(np.concatenate([i, j]))
            i, j = np.searchsorted(rows, i), np.searchsorted(rows, j)
            ids, sizes, unit = ids[rows], sizes[rows], unit[rows]
            own, probed = np.zeros((len(rows), TABLES), np.int64), np.zeros((len(rows), TABLES, 1 + PROBES), np.int64)
            for dim in np.unique(sizes).tolist():
                of = sizes == dim
                own[of], probed[of] = signature(unit[of, :dim])
            fresh_pair = _first_meeting(own, probed, table.column("cell").to_numpy()[rows], ids, i, j)
            copies = table.column("copies").to_numpy()[rows]
            n = np.zeros(len(rows), np.int64)
            np.add.at(n, i[fresh_pair], copies[j[fresh_pair]])
            np.add.at(n, j[fresh_pair], copies[i[fresh_pair]])
            # rows of the same id in several cells are one vertex
            unique, vertex = np.unique(ids, return_inverse=True)
            root = unique[_roots(len(unique), vertex[i], vertex[j])]
            total = np.bincount(vertex, weights=n, minlength=len(unique)).astype(np.int64)
            kind = table.column("id").type
            yield pa.RecordBatch.from_arrays([pa.array(unique, kind), pa.array(root, kind), pa.array(total)], names=["id", "root", "n"])

    return dealt.mapInArrow(tidy(compared), f"id {kinds['id']}, root {kinds['id']}, n long")


def dedup(vectors: DataFrame, threshold: float = 0.93, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links``, ``component_id``, the smallest id reachable by links, and ``kept``."""
    rows = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    zero = ~F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("good", F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")) & ~F.coalesce(zero, F.lit(True)))
    good = rows.filter("good").select("id", "label", "vector")
    classes = written(good.distinct().groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "vector-classes")
    found = written(links(classes, threshold), "vector-links")
    others = found.groupBy("id").agg(F.sum("n").alias("others"))
    roots = components(found.filter("id <> root").select(F.col("id").alias("src"), F.col("root").alias("dst")))
    linked = classes.join(others, "id", "left").join(roots, "id", "left").select("label", "vector", F.col("id").alias("rep"), "copies", "others", "component", F.col("copies").alias("c"))
    placed = join_counted(good, written(linked, "placed-classes"), ["label", "vector"], good.count())
    n_links = (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).cast("long")
    placed = placed.select("id", n_links.alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    alone = rows.filter("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return placed.unionByName(alone).select(F.col("id").alias(id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
