"""Numpy views over Arrow string columns: one byte buffer for many texts.

The operators of this subpackage that look at bytes, words or shingles work on
whole Arrow batches instead of Python strings.  A text column is seen as one
``uint8`` buffer plus offsets, and words get 64-bit hashes computed for all
words of the buffer at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; temporary arrays take some forty times this.
CHUNK_BYTES = 2 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Values of each byte at each of the first places of a word.
_PLACES = 64
_VALUES = mix(np.arange(_PLACES * 256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def parts(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``limit`` bytes (one text may exceed it): start, end, bytes, offsets."""
    data, offsets = flat(column)
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, ASCII letters lower-cased, and each text's first word.

    Words are maximal runs of bytes other than space and 0x09-0x0D, and never
    cross texts.  Each byte is scrambled together with its place in the word, and
    these values are summed modulo 2**64 and scrambled: equal hashes of different words
    are a matter of chance alone, however the words are built.
    """
    n = len(data)
    n_texts = len(offsets) - 1
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(n_texts + 1, np.int64)
    inside = np.empty(n + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SEPARATOR[data], out=inside[1:-1])
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    begin = np.zeros(n, np.int32)
    begin[starts] = starts
    place = np.arange(n, dtype=np.int32) - np.maximum.accumulate(begin)
    low = _LOWER[data]
    values = _VALUES[(np.minimum(place, _PLACES - 1) << 8) | low]
    far = np.flatnonzero((place >= _PLACES) & inside[1:-1])
    if len(far):
        values[far] = mix((place[far].astype(np.uint64) << np.uint64(8) | low[far]) + np.uint64(0x9E3779B97F4A7C15))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return mix(total[ends] - total[starts]), np.searchsorted(starts, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of each text, sorted within texts: hashes and offsets.

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    lengths = np.diff(bounds)
    counts = np.where(lengths >= width, lengths - width + 1, (lengths > 0).astype(np.int64))
    total = int(counts.sum())
    owner = np.repeat(np.arange(len(lengths)), counts)
    if total == 0:
        return np.zeros(0, np.uint64), np.zeros(len(lengths) + 1, np.int64)
    begin = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(counts, out=begin[1:])
    at = np.arange(total) - begin[owner] + bounds[:-1][owner]
    size = np.minimum(lengths, width)[owner]
    h = np.zeros(total, np.uint64)
    for k in range(width):
        use = size > k
        if use.all():
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[at + k])
        else:
            h[use] = mix(h[use] * np.uint64(0xD6E8FEB86659FD93) + words[at[use] + k])
    h = mix(h + size.astype(np.uint64))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(total, bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=len(lengths)), out=out[1:])
    return h, out


def crc_fold(ids: np.ndarray, modulus: int) -> np.ndarray:
    """crc32 of each id written as decimal text, modulo ``modulus``."""
    import zlib

    return np.fromiter((zlib.crc32(b"%d" % i) % modulus for i in ids.tolist()), np.int64, len(ids))
