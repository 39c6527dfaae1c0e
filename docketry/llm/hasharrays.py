"""Counts by 64-bit key, made in Spark and kept as sorted arrays that workers map into memory.

Tasks count the keys of their rows, deal them out by bucket as packed blobs,
and one task per bucket merges its blobs and writes one file into the shared
folder: sorted keys and their counts.  Files appear under their final name at
once and have the same content whichever attempt writes them, so lost tasks
can be run again.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that a task holds before it packs them.
PENDING = 3 << 20
_CODEC = pa.Codec("zstd", 1)
BLOBS = "bucket int, size long, blob binary"


#: Bytes of text whose keys a bucket holds: a task merges one in memory.
BUCKET_BYTES = 64 << 20


def bucket_bits(spark: SparkSession, n_bytes: int = 0) -> int:
    """Enough buckets for the session's shuffle partitions, 256 at least, and for so many bytes of text."""
    return max(8, (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length(), (n_bytes // BUCKET_BYTES).bit_length())


def _planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()


def _narrow(a: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest unsigned type."""
    top = int(a.max()) if len(a) else 0
    return a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


def escaped(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in a byte each, and those from 255 on by their places."""
    large = np.flatnonzero(counts >= 255)
    return {"counts": np.minimum(counts, 255).astype(np.uint8), "large": _narrow(large), "large_counts": _narrow(counts[large])}


def unescaped(arrays: dict[str, np.ndarray], places: np.ndarray) -> np.ndarray:
    """The counts at these places."""
    out = arrays["counts"][places].astype(np.int64)
    at = np.flatnonzero(out == 255)
    if len(at):
        out[at] = arrays["large_counts"][np.searchsorted(arrays["large"], places[at].astype(arrays["large"].dtype))]
    return out


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts as a compressed blob."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype(np.uint64)
    counts = _narrow(counts)
    raw = bytes([counts.itemsize]) + len(keys).to_bytes(8, "little") + _planes(steps) + _planes(counts)
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = _CODEC.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    size, n = raw[0], int.from_bytes(raw[1:9], "little")

    def array(at: int, item: int) -> np.ndarray:
        return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * item, at).reshape(item, n).T).view(f"<u{item}").ravel()

    return np.cumsum(array(9, 8), dtype=np.uint64), array(9 + 8 * n, size).astype(np.uint64)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different whole numbers, sorted; which of them each value is; and a place of each.

    Places take the lowest bits of the numbers, moved up as far as they go, so that single numbers are sorted and
    not places by them; where that cuts bits off that put values in order, places are sorted.
    """
    n = len(values)
    if not n:
        return values, np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = values.min()
    moved = (values - low).astype(np.uint64)
    bits, mask = 64 - int(moved.max()).bit_length(), np.uint64((1 << (n - 1).bit_length()) - 1)
    if bits < 64:
        moved <<= np.uint64(bits)
    moved &= ~mask
    moved |= np.arange(n, dtype=np.uint64)
    moved.sort()
    order = (moved & mask).astype(np.int64)
    ordered = values[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(values)
        ordered = values[order]
    first = np.ones(n, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    which = np.empty(n, np.int64)
    which[order] = np.cumsum(first) - 1
    return ordered[first], which, order[first]


class Counter:
    """Counts keys of one task; yields packed blobs by bucket, ``bucket_of`` sorted keys."""

    def __init__(self, bucket_of) -> None:
        self.bucket_of, self.held, self.n = bucket_of, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(keys)
        self.n += len(keys)
        if self.n >= PENDING:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            keys, counts = np.unique(np.concatenate(self.held), return_counts=True)
            self.held, self.n = [], 0
            bucket = _narrow(self.bucket_of(keys))
            order = np.argsort(bucket, kind="stable")
            starts = run_starts(bucket[order])
            names, parts = bucket[order[starts]], np.split(order, starts[1:])
            for k in range(0, len(parts), 64):
                some = parts[k : k + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[k : k + 64], pa.int32()), pa.array([len(p) for p in some], pa.int64()), pa.array([pack(keys[p], counts[p].astype(np.uint64)) for p in some], pa.binary())],
                    names=["bucket", "size", "blob"],
                )


def merged(blobs: DataFrame, buckets: int) -> DataFrame:
    """Blobs dealt out so that a task has all of a bucket, bucket after bucket; each of ``buckets`` has one, if an empty one."""
    nothing = np.zeros(0, np.uint64)
    empty = blobs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("size"), F.lit(pack(nothing, nothing)).alias("blob"))
    return blobs.unionByName(empty).repartition("bucket").sortWithinPartitions("bucket")


def run_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(sorted_keys)), bool), sorted_keys[1:] != sorted_keys[:-1]]))


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of such a task: each bucket's keys, sorted, and their total counts."""
    now, blobs = -1, []

    def done() -> tuple[int, np.ndarray, np.ndarray]:
        parts = [unpack(b) for b in blobs]
        keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
        many = np.flatnonzero(counts > 1)
        again, more = keys[many], counts[many] - np.uint64(1)
        keys.sort()
        first = run_starts(keys)
        total = np.diff(np.append(first, len(keys))).astype(np.uint64)
        keys = keys[first]
        np.add.at(total, np.searchsorted(keys, again), more)
        return now, keys, total

    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            if bucket != now and blobs:
                yield done()
                blobs = []
            now = bucket
            blobs.append(blob)
    if blobs:
        yield done()


def local_path(folder: str) -> str | None:
    url = urlparse(folder)
    return url.path if url.scheme in ("", "file") else None


def put(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays into one file of the shared folder; readers never see half of it."""
    head = ";".join(f"{k},{a.dtype.str},{len(a)}" for k, a in arrays.items()).encode().ljust(256)
    body = [a.tobytes().ljust(-(-a.nbytes // 8) * 8, b"\0") for a in arrays.values()]
    path = local_path(folder)
    if path is None:
        import pyarrow.fs as fs

        store, at = fs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        with store.open_output_stream(f"{at}/{name}") as out:
            for part in (head, *body):
                out.write(part)
        return
    os.makedirs(path, exist_ok=True)
    with open(temporary := f"{path}/.{name}-{uuid.uuid4().hex}", "wb") as out:
        for part in (head, *body):
            out.write(part)
    os.replace(temporary, f"{path}/{name}")


def get(folder: str, name: str) -> dict[str, np.ndarray]:
    """Arrays of a file, mapped into memory where the shared folder is mounted, or else read; a file that isn't there is an error.

    A worker keeps the files of one folder: with the next folder those of the last are let go.
    """
    return _files_of(folder)(name)


@lru_cache(1)
def _files_of(folder: str) -> Callable[[str], dict[str, np.ndarray]]:
    return lru_cache(8192)(partial(_read, folder))


def _read(folder: str, name: str) -> dict[str, np.ndarray]:
    path = local_path(folder)
    if path is not None:
        raw = np.asarray(np.memmap(f"{path}/{name}", np.uint8, "r"))
    else:
        import pyarrow.fs as fs

        store, at = fs.FileSystem.from_uri(folder)
        raw = np.frombuffer(store.open_input_file(f"{at}/{name}").read(), np.uint8)
    out, at = {}, 256
    for item in bytes(raw[:256]).decode().strip().split(";"):
        key, kind, n = item.split(",")
        size = int(n) * np.dtype(kind).itemsize
        out[key] = raw[at : at + size].view(kind)
        at += -(-size // 8) * 8
    return out


def lookup(folder: str, prefix: str, buckets: np.ndarray, keys: np.ndarray, fields: tuple[str, ...], key: str = "keys") -> list[np.ndarray]:
    """For each key, in any order, its place in its bucket's file (-1 if absent) and the values of ``fields`` there (else 0)."""
    place = np.full(len(keys), -1, np.int64)
    values = [np.zeros(len(keys), np.uint64) for _ in fields]
    step = buckets[1:] - buckets[:-1]
    inorder = ((step > 0) | (step == 0) & (keys[1:] >= keys[:-1])).all()
    order = np.arange(len(keys)) if inorder else np.lexsort((keys, buckets))
    names, starts = np.unique(buckets[order], return_index=True)
    for name, rows in zip(names.tolist(), np.split(order, starts[1:]), strict=True):
        arrays = get(folder, f"{prefix}{name:06d}")
        there = arrays[key]
        if not len(there):
            continue
        at = np.minimum(np.searchsorted(there, keys[rows].astype(there.dtype)), len(there) - 1)
        hit = there[at] == keys[rows].astype(there.dtype)
        rows, at = rows[hit], at[hit]
        place[rows] = at
        for v, f in zip(values, fields, strict=True):
            v[rows] = arrays[f][at]
    return [place, *values]
