"""BPE encoding and decoding with tree concatenation of long texts.

A vocabulary file of the ``tokenizers`` library says how texts are normalised,
split into words and merged.  Words are merged once per worker and remembered,
so most of a text is looked up.

Texts of more than ``LONG`` characters are cut into equal pieces wherever the
cut falls, words included.  Spark deals the pieces out, encodes them in
parallel, and joins neighbours pairwise, level by level.  At a join the words
around the cut are scanned again in a window that grows until its word starts
agree with those of the right half; what lies left of it is settled already.
A word that the cut has split and that is long itself is merged again in a
window around the cut that grows until its first token agrees with the left
half's and a later one with the right half's.  Both are exact: scanning
depends on nothing left of a word's start, and a sequence of tokens is the
encoding of its text if each pair of neighbours is that of its own.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .shared import fresh, small_batches, tidy

LONG = 32_768
#: Words of more characters than this, when cut, are joined by windows of tokens.
LONG_WORD = 512
#: A word that ends so many characters before a cut doesn't depend on what follows.
LOOK_AHEAD = 3
CACHED_WORDS = 100_000
CACHED_RUNS = 200_000
#: Characters whose class, case and normal form are the same in all Unicode versions since 5.
_PLAIN = re.compile(r"[\t-\r -~\x85\xa0-įı-ȶ]*")


def _for_plain(pattern: str) -> str:
    """A word pattern whose classes of letters, numbers and white space are spelt out for plain characters."""
    plain = [chr(i) for i in range(0x237) if _PLAIN.fullmatch(chr(i))]

    def spelt(kind: str) -> str:
        return "".join(re.escape(x) for x in plain if (x.isspace() if kind == "Z" else unicodedata.category(x)[0] == kind))

    return pattern.replace(r"\p{L}", spelt("L")).replace(r"\p{N}", spelt("N")).replace(r"\s", spelt("Z"))


class Codec:
    """Encoding of words and texts by one vocabulary file; a cache of words."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        spec["truncation"] = spec["padding"] = None
        self.full = Tokenizer.from_str(json.dumps(spec))
        self.normalizer = self.full.normalizer
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = re.compile(_for_plain(pattern))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        vocab = self.full.get_vocab(with_added_tokens=True)
        tokens = [""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            tokens[i] = token
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.token_length = np.array([len(t.removesuffix(suffix)) if suffix else len(t) for t in tokens], np.int64)
        self.cache: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        """Encode the words that aren't remembered yet."""
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        for w in words:
            if w not in self.cache:
                self.cache[w] = self.merge(self.symbols(w)).astype("<u4").tobytes()

    def learn_runs(self, runs: set[str]) -> None:
        """Encode runs without white space that aren't remembered yet; each is some words."""
        if len(self.runs) > CACHED_RUNS:
            self.runs.clear()
        new = [(r, self.word.findall(r)) for r in runs if r not in self.runs]
        self.learn({w for _, words in new for w in words})
        for r, words in new:
            self.runs[r] = b"".join([self.cache[w] for w in words])

    def scan(self, text: str) -> list[tuple[int, int]]:
        """Words of a normalised text: start and end."""
        if _PLAIN.fullmatch(text):
            return [m.span() for m in self.word.finditer(text)]
        return [span for _, span in self.full.pre_tokenizer.pre_tokenize_str(text)]

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """Encodings of whole texts, as little-endian unsigned 32-bit ids."""
        out: list[bytes] = [b""] * len(texts)
        split: list[tuple[int, list[str]]] = []
        other: list[int] = []
        for i, text in enumerate(texts):
            if "<|" not in text and _PLAIN.fullmatch(text):
                split.append((i, text.lower().split()))
            else:
                other.append(i)
        self.learn_runs(set().union(*(w for _, w in split)))
        for i, runs in split:
            out[i] = b"".join(map(self.runs.__getitem__, runs))
        if other:
            for i, e in zip(other, self.full.encode_batch([texts[i] for i in other], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def symbols(self, word: str) -> str:
        """A word's bytes as the vocabulary writes them."""
        return word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_byte_symbols())

    def merge(self, symbols: str) -> np.ndarray:
        return np.array([t.id for t in self.full.model.tokenize(symbols)], np.uint32) if symbols else np.zeros(0, np.uint32)


@lru_cache(1)
def _byte_symbols() -> dict[int, int]:
    """Byte to printable character, as byte-level vocabularies have it."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(rest)}


@lru_cache(4)
def token_strings(path: str) -> list[str]:
    """The vocabulary's tokens by id, special tokens included."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    by_id = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [by_id.get(i, "") for i in range(max(by_id) + 1)]


def decode_ids(tokens: list[str], ids: bytes) -> str:
    """The tokens as the library writes them: without a decoder, parted by spaces."""
    return " ".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(4)
def codec(path: str) -> Codec:
    return Codec(path)


@dataclass
class Encoded:
    """A normalised text, its words, and each word's tokens."""

    text: str
    words: list[tuple[int, int]]
    ids: list[np.ndarray]

    @classmethod
    def of(cls, c: Codec, text: str) -> Encoded:
        words = c.scan(text)
        strings = [text[a:b] for a, b in words]
        c.learn(set(strings))
        return cls(text, words, [np.frombuffer(c.cache[w], np.uint32) for w in strings])


def join_word(c: Codec, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray, window: int = 64) -> np.ndarray:
    """Tokens of a word from those of its two halves, given as symbols."""
    ends_l, ends_r = np.cumsum(c.token_length[left_ids]), np.cumsum(c.token_length[right_ids])
    while True:
        i = int(np.searchsorted(ends_l, len(left) - window, "right")) if window < len(left) else 0
        a = int(ends_l[i - 1]) if i else 0
        j = int(np.searchsorted(ends_r, window)) + 1 if window < len(right) else len(right_ids)
        j = min(j, len(right_ids))
        b = int(ends_r[j - 1]) if j < len(right_ids) else len(right)
        middle = c.merge(left[a:] + right[:b])
        # the halves' last tokens have the mark of a word's end, and can't agree
        agrees = i == 0 or (i < len(left_ids) - 1 and middle[0] == left_ids[i])
        if agrees and b == len(right):
            return np.concatenate([left_ids[:i], middle])
        if agrees:
            ends_m = np.cumsum(c.token_length[middle]) + a - len(left)
            at = {int(e): k for k, e in enumerate(ends_m[:-1].tolist()) if e > c.token_length[middle[k]]}
            for k in range(j - 2, 0, -1):
                m = at.get(int(ends_r[k]))
                if m is not None and middle[m] == right_ids[k]:
                    return np.concatenate([left_ids[:i], middle[: m + 1], right_ids[k + 1 :]])
        window *= 2


def join(c: Codec, left: Encoded, right: Encoded, window: int = 64) -> Encoded:
    """The encoding of the concatenated text, exactly as if it had never been cut."""
    if not left.text or not right.text:
        return right if not left.text else left
    cut = len(left.text)
    i = len(left.words) - 1
    while i > 0 and left.words[i][0] > cut - LOOK_AHEAD:
        i -= 1
    begin = left.words[i][0] if i >= 0 else cut
    i = max(i, 0)
    if begin > cut - LOOK_AHEAD:
        begin = 0
    starts = {s: k for k, (s, _) in enumerate(right.words)}
    while True:
        seen = left.text[begin:] + right.text[:window]
        whole = window >= len(right.text)
        scanned = [(a + begin, b + begin) for a, b in c.scan(seen)]
        again, sync = [], len(right.words)
        for a, b in scanned:
            if a >= cut and a - cut in starts and (whole or a <= begin + len(seen) - LOOK_AHEAD):
                sync = starts[a - cut]
                break
            again.append((a, b))
        else:
            if not whole:
                window *= 2
                continue
        break
    text = left.text + right.text
    ids = []
    for a, b in again:
        if a < cut < b and b - a > LONG_WORD and (a, cut) == left.words[-1] and right.words and right.words[0] == (0, b - cut):
            ids.append(join_word(c, c.symbols(text[a:cut]), left.ids[-1], c.symbols(text[cut:b]), right.ids[0]))
        else:
            c.learn({text[a:b]})
            ids.append(np.frombuffer(c.cache[text[a:b]], np.uint32))
    words = left.words[:i] + again + [(a + cut, b + cut) for a, b in right.words[sync:]]
    return Encoded(text, words, left.ids[:i] + ids + right.ids[sync:])


def join_all(c: Codec, pieces: list[Encoded]) -> np.ndarray:
    """Joins neighbours level by level until one encoding is left."""
    while len(pieces) > 1:
        pieces = [join(c, pieces[k], pieces[k + 1]) if k + 1 < len(pieces) else pieces[k] for k in range(0, len(pieces), 2)]
    return np.concatenate([np.zeros(0, np.uint32), *pieces[0].ids]) if pieces else np.zeros(0, np.uint32)


def cut(c: Codec, text: str, size: int = LONG) -> Iterator[tuple[int, str | None, int]]:
    """Pieces of a text: number of its unbroken part, the normalised piece, or else a special token's id."""
    part, at = 0, 0
    for found in [*c.special_pattern.finditer(text), None]:
        plain = text[at : found.start() if found else len(text)]
        plain = plain.lower() if _PLAIN.fullmatch(plain) else c.normalizer.normalize_str(plain)
        for k in range(0, len(plain), size):
            yield part, plain[k : k + size], -1
        if found:
            yield part + 1, None, c.special[found[0]]
            at = found.end()
        part += 2


def encode(documents: DataFrame, vocabulary: str, text: str = "text", into: str = "ids", long: int = LONG) -> DataFrame:
    """``documents`` with ``into``: each whole text's token ids, as little-endian unsigned 32-bit integers.

    Null and empty texts have no tokens.  Repeated rows stay; other columns are
    passed through, and one named as ``into`` is replaced.
    """

    @F.arrow_udf("binary")
    @tidy
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(vocabulary)
        for texts in batches:
            found: list[bytes] = []
            for start, end, _, _ in ta.parts(texts):
                found += c.encode_plain([t or "" for t in texts.slice(start, end - start).to_pylist()])
            yield pa.array(found, pa.binary())

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(cut(c, value, long))
                for k in range(0, len(rows), 64):
                    part, piece, special = zip(*rows[k : k + 64], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(part)), pa.array(range(k, k + len(part)), pa.int32()), pa.array(part, pa.int32()), pa.array(piece, pa.string()), pa.array(special, pa.int32())],
                        names=["_key", "_no", "_part", "_piece", "_special"],
                    )

    def piece_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            lists = []
            for piece in batch.column("_piece").to_pylist():
                e = Encoded.of(c, piece or "")
                lists.append((np.array([len(x) for x in e.ids], "<i4").tobytes(), np.concatenate([np.zeros(0, np.uint32), *e.ids]).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.binary()) for x in zip(*lists, strict=True))], names=[*batch.schema.names, "_counts", "_ids"])

    def joined(group: pa.Table) -> pa.Table:
        c = codec(vocabulary)
        out, run = [], []
        rows = sorted(group.to_pylist(), key=lambda r: r["_no"])
        for k, r in enumerate(rows):
            if r["_special"] >= 0:
                out.append(np.array([r["_special"]], np.uint32))
                continue
            words = c.scan(r["_piece"])
            ids = np.split(np.frombuffer(r["_ids"], "<u4"), np.cumsum(np.frombuffer(r["_counts"], "<i4"))[:-1]) if words else []
            run.append(Encoded(r["_piece"], words, ids))
            if k + 1 == len(rows) or rows[k + 1]["_part"] != r["_part"]:
                out.append(join_all(c, run))
                run = []
        ids = np.concatenate([np.zeros(0, np.uint32), *out]).astype("<u4").tobytes()
        return pa.table({"_key": pa.array([rows[0]["_key"]]), "_long_ids": pa.array([ids], pa.binary())})

    small_batches(documents.sparkSession)
    key, found = fresh(documents, "_key", "_long_ids")
    documents = documents.withColumn(text, F.col(text).cast("string"))
    is_long = F.coalesce(F.char_length(text) > long, F.lit(False))
    short = documents.filter(~is_long).withColumn(into, encoded(F.col(text)))
    tall = documents.filter(is_long).withColumn(key, F.sha2(F.col(text), 256))
    # equal long texts are encoded once; a group holds the pieces of one text
    once = tall.groupBy(F.col(key).alias("_key")).agg(F.first(text).alias("_text"))
    dealt = once.mapInArrow(tidy(pieces), "_key string, _no int, _part int, _piece string, _special int").repartition("_key", "_no")
    done = dealt.mapInArrow(tidy(piece_ids), "_key string, _no int, _part int, _piece string, _special int, _counts binary, _ids binary")
    joined_ids = done.groupBy("_key").applyInArrow(joined, "_key string, _long_ids binary").toDF(key, found)
    tall = tall.join(joined_ids, key, "left").withColumn(into, F.coalesce(found, F.lit(b""))).drop(key, found)
    return short.unionByName(tall)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text that the library's decode(ids, skip_special_tokens=False) gives; null ids give an empty text."""

    @F.arrow_udf("string")
    @tidy
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = token_strings(vocabulary)
        for column in batches:
            yield pa.array((decode_ids(tokens, x.as_py() or b"") for x in column), pa.string(), size=len(column))

    return encoded.withColumn(into, decoded(F.col(ids)))
