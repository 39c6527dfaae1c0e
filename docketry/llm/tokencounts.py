"""Token counts by rank-synchronous merging of ragged arrays.

A vocabulary file of the ``tokenizers`` library, byte-level BPE, says what the
tokens of a text are; only their number is wanted.  The texts of a batch are one
byte buffer.  Special tokens are found first and count one each.  What lies
between is split into pre-tokens for the whole buffer at once: a code point's
class (letter, number, white space, other) is asked of the library when the
code point is first met, and whether a pre-token starts at a place follows
from the classes around it.

The batch's different pre-tokens are then a ragged array of symbols, their
bytes.  In each round every sequence finds its pair of neighbours of lowest
rank, all places of that pair in it are merged at once, from left to right, and
only the pairs beside them are looked up again.  A sequence without a pair that
merges is done, and leaves; the symbols it has left are its tokens.  This is
what merging one pair at a time gives, as a merged symbol's own pairs all rank
behind the merge that made it; that is checked when the file is read.  Before
the first round sequences are cut between bytes that stand on two sides of
no merge, so that long ones fall apart.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .bpe import _byte_symbols
from .shared import small_batches, tidy

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
NO_RANK = np.int32(np.iinfo(np.int32).max)
#: What the file must say for this operator to count as the library does; None for what it must not have.
EXPECTED = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}


def _is(letters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(letters)] = True
    return table


_ASCII_LETTER = _is(bytes([*range(65, 91), *range(97, 123)]))
#: Fixed values of byte-level pre-tokenizers: what an apostrophe takes with it.
_ONE = _is(b"stmd")
_TWO = [(ord("r"), ord("e")), (ord("v"), ord("e")), (ord("l"), ord("l"))]


class Counter:
    """Counts tokens by one vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k, v in EXPECTED.items() if model.get(k, v) not in (v, None, "")]
        if model["type"] != "BPE" or odd or spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError(f"{path}: only plain byte-level BPE is counted here")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: only added tokens that are matched as they stand are counted here")
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        special = sorted((t["content"].encode() for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = special
        self.special_pattern = re.compile(b"|".join(map(re.escape, special)) or rb"(?!)")
        #: Whether a long text may be cut between two words: not if a special token holds such a place.
        self.cuts = not any(re.search(rb"[A-Za-z] [A-Za-z]", s) for s in special)

        vocab, symbol = model["vocab"], _byte_symbols()
        n = max(vocab.values()) + 1
        self.width = n
        by_byte = np.array([vocab[chr(symbol[b])] for b in range(256)], np.int32)
        merges: dict[tuple[int, int], tuple[int, int]] = {}
        ends = {v: k for k, v in symbol.items()}
        self.crossing = np.zeros((256, 256), bool)
        made = np.full(n, -1)
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            merges[vocab[a], vocab[b]] = rank, vocab[a + b]
            self.crossing[ends[ord(a[-1])], ends[ord(b[0])]] = True
            made[vocab[a + b]] = max(made[vocab[a + b]], rank)
        pairs = np.array(list(merges), np.int64).reshape(-1, 2)
        ranks = np.array([r for r, _ in merges.values()], np.int32)
        if (made[pairs] >= ranks[:, None]).any():
            raise ValueError(f"{path}: a pair ranks before the merge that makes one of its symbols")
        keys = pairs[:, 0] * n + pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(ranks[order], NO_RANK)
        self.result = np.zeros(len(model["merges"]) + 1, np.int32)
        for rank, into in merges.values():
            self.result[rank] = into
        self.by_byte = by_byte
        self.first = self.rank(np.repeat(by_byte, 256), np.tile(by_byte, 256)).reshape(256, 256)
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.learn(np.arange(128))

    def learn(self, points: np.ndarray) -> None:
        """Ask the library for the classes of code points: what they stay in one piece with."""
        for p in np.unique(points[self.classes[points] == UNKNOWN]).tolist():
            if 0xD800 <= p < 0xE000:  # not in texts
                self.classes[p] = OTHER
                continue
            beside = (len(self.pre_tokenizer.pre_tokenize_str(x + chr(p))) == 1 for x in "a1!")
            self.classes[p] = next((c for c, same in zip((LETTER, NUMBER, OTHER), beside, strict=True) if same), SPACE)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols."""
        key = a.astype(np.int64) * self.width + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def pre_tokens(self, data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Where pre-tokens start in a buffer: texts and special tokens start at ``bounds``; ``inside`` marks special tokens behind their first byte."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        byte = data[lead]
        kind = self.classes[byte & 0x7F]
        wide = np.flatnonzero(byte >= 0x80)
        if len(wide):
            at, head = lead[wide], byte[wide].astype(np.int64)
            size = 2 + (head >= 0xE0) + (head >= 0xF0)
            point = head & (0x7F >> size)
            for k in range(1, 4):
                has = size > k
                point[has] = point[has] << 6 | (data[np.minimum(at[has] + k, len(data) - 1)] & 0x3F)
            point = np.minimum(point, 0x10FFFF)
            self.learn(point)
            kind[wide] = self.classes[point]
        n = len(lead)
        begins = np.zeros(n + 3, bool)  # beyond the end lies another text
        begins[n:] = True
        begins[np.searchsorted(lead, bounds)] = True
        kind, byte = np.append(kind, [UNKNOWN] * 3).astype(np.uint8), np.append(byte, [0] * 3).astype(np.uint8)
        starts = begins.copy()
        # a blank goes with what follows; of other white space the last goes alone
        starts[1:] |= (kind[1:] != kind[:-1]) & (byte[:-1] != 0x20)
        starts[:-1] |= (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begins[1:]
        quote = np.flatnonzero(starts[:n] & (byte[:n] == 0x27))
        quote = quote[~begins[quote + 1]]
        one = quote[_ONE[byte[quote + 1]]]
        starts[one + 1], starts[one + 2] = False, True
        longer = quote[~begins[quote + 2]]
        two = longer[np.logical_or.reduce([(byte[longer + 1] == x) & (byte[longer + 2] == y) for x, y in _TWO])]
        starts[two + 1], starts[two + 3] = False, True
        found = lead[starts[:n]]
        return found[~inside[found]] if len(inside) else found

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """How many symbols each sequence of bytes, none of them empty, has when nothing merges any more."""
        n = len(offsets) - 1
        out = np.zeros(n, np.int64)
        if not n:
            return out
        starts = np.ones(len(data), bool)
        np.logical_not(self.crossing[data[:-1], data[1:]], out=starts[1:])
        starts[offsets[:-1]] = True
        first = np.flatnonzero(starts)
        symbols, sizes = self.by_byte[data], np.diff(np.append(first, len(data)))
        owner = np.searchsorted(offsets, first, "right") - 1
        ranks = np.full(len(data), NO_RANK, np.int32)
        within = np.flatnonzero(~starts[1:])
        ranks[within] = self.first[data[within], data[within + 1]]
        while True:
            lowest = np.minimum.reduceat(ranks, first)
            done = lowest == NO_RANK
            if done.any():
                out += np.bincount(owner[done], sizes[done], n).astype(np.int64)
                stay = np.repeat(~done, sizes)
                symbols, ranks = symbols[stay], ranks[stay]
                owner, sizes, lowest = owner[~done], sizes[~done], lowest[~done]
                if not len(owner):
                    return out
            hit = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            # of a run of equal symbols every other pair is merged, from its left end
            run = np.flatnonzero(np.concatenate([[True], np.diff(hit) > 1]))
            hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))) % 2 == 0]
            symbols[hit] = self.result[ranks[hit]]
            gone = np.zeros(len(symbols), bool)
            gone[hit + 1] = True
            ends = np.cumsum(sizes)
            sizes = sizes - np.add.reduceat(gone.astype(np.int64), ends - sizes)
            symbols, ranks, hit = symbols[~gone], ranks[~gone], hit - np.arange(len(hit))
            first = np.cumsum(sizes) - sizes
            last = np.zeros(len(symbols) + 1, bool)
            last[first + sizes - 1] = last[-1] = True  # and what lies before the first is of another sequence
            ranks[hit] = NO_RANK
            again = np.concatenate([hit, hit - 1])
            again = again[~last[again]]
            ranks[again] = self.rank(symbols[again], symbols[again + 1])

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a buffer."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(n, np.int64)
        special = self._specials(data, offsets)
        inside = np.zeros(len(data) if len(special) else 0, bool)
        for start, end in special.tolist():
            inside[start + 1 : end] = True
        bounds = offsets[:-1][np.diff(offsets) > 0]
        bounds = np.unique(np.concatenate([bounds, special.ravel()]))
        starts = self.pre_tokens(data, bounds[bounds < len(data)], inside)
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        size = self.lengths(*ta.flat(words.dictionary))[words.indices.to_numpy()]
        size[np.searchsorted(starts, special[:, 0])] = 1
        total = np.concatenate([[0], np.cumsum(size)])
        at = np.searchsorted(starts, offsets)
        return total[at[1:]] - total[at[:-1]]

    def _specials(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Start and end of each special token in the texts, none across two of them."""
        raw = data.tobytes()
        found: list[tuple[int, int]] = []
        if self.special_pattern.search(raw):
            for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                found += (m.span() for m in self.special_pattern.finditer(raw, start, end))
        return np.array(found, np.int64).reshape(-1, 2)

    def count_column(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; a text longer than a chunk goes in pieces, cut where a letter, a blank and a letter meet."""
        out = []
        for start, end, data, offsets in ta.parts(texts):
            if end - start > 1 or len(data) <= ta.CHUNK_BYTES or not self.cuts:
                out.append(self.count(data, offsets))
                continue
            letter = _ASCII_LETTER[data]
            blanks = np.flatnonzero((data[1:-1] == 0x20) & letter[:-2] & letter[2:]) + 1
            near = np.searchsorted(blanks, np.arange(ta.CHUNK_BYTES, len(data), ta.CHUNK_BYTES))
            edges = np.unique(np.concatenate([[0], blanks[near[near < len(blanks)]], [len(data)]]))
            out.append(np.array([sum(int(self.count(data[a:b], np.array([0, b - a]))[0]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))]))
        return np.concatenate([np.zeros(0, np.int64), *out])


@lru_cache(4)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(documents: DataFrame, vocabulary: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``documents`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text, and ``over_limit``, whether these are more than ``limit``.

    Null and empty texts have none.  Repeated rows stay, each counted; other columns
    are passed through, and those named as a result are replaced.  An empty table
    gives an empty one.
    """

    @F.arrow_udf("long")
    @tidy
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = counter(vocabulary)
        for texts in batches:
            yield pa.array(c.count_column(texts), pa.int64())

    small_batches(documents.sparkSession)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = documents.withColumns({"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": counted(whole)})
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
