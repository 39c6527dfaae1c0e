"""LM scoring: an interpolated modified Kneser-Ney model of any order from 2 on, counted in Spark.

Words are 64-bit hashes.  A first pass counts words into sorted hash arrays; a
word's number is its place in them.  A pass for each further level counts
n-grams by the number of their first n - 1 words and the number of the last,
and an n-gram's number is again its place.  The last pass counts those of the
model's order; from the highest level down, each level's tasks derive what the
level below needs: how many distinct words stand before each of its n-grams.
All arrays lie in the shared folder; tasks map them into memory and look up
whole batches at once.  Only totals, counts of counts and the few contexts that
hold a noticeable share of a level reach the driver.

A text's tokens are its words and one end; as many starts as a context has
words come before.  The probability of token w after the n - 1 words h is

    P(w | h) = max(c(hw) - D, 0) / c(h) + g(h) * P(w | h without its first word),
    P(w) = max(n(w) - D', 0) / n + g / (V + 1)

with c(hw) the n-gram's count at the highest level and below it the number of
distinct tokens seen before hw, c(h) their sum over w, n(w) the number of
distinct tokens seen before w, D the modified discounts of the level for counts
of one, two and more, and g what they set free.  The V words of the training
texts and one unknown word share the last term, so the probabilities after any
h sum to 1.  After an unknown h the probability is that after h without its
first word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hasharrays as ha
from . import textarrays as ta
from .shared import new_folder, small_batches

END = np.uint64(0x5D1E4F3A9B27C680)
#: N-grams of a bucket whose shorter ones are looked up at once.
_AT_ONCE = 1 << 18
#: Contexts before more different words than this have their sums stored; those of others are made from their counts.
LONG = 16
#: Tokens that are looked up at once: each lookup visits every bucket, so that few are dear.
TOKENS = 1 << 20
#: Bytes of text that are cut into words at once, so that what is worked out of them stays in a core's cache.
HASHED = 1 << 17
_MADE = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("total", pa.int64()), ("place", pa.list_(pa.int64())), ("count", pa.list_(pa.int64()))])


def discounts(n: list[int]) -> np.ndarray:
    """What counts of 0, 1, 2 and more lose, from how many things have counts 1 to 4."""
    out = np.array([0.0, 0.5, 1.0, 1.5])
    n1, n2, n3, n4 = (float(x) for x in n)
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        for k, (low, high) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
            if low:
                d = k - (k + 1) * y * high / low
                out[k] = d if 0 < d <= k else out[k]
    return out


@dataclass
class Level:
    """N-grams of one length: numbers, contexts and discounts."""

    base: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # first number of each bucket's n-grams
    top: np.ndarray = field(default_factory=lambda: np.zeros((0, 5), np.int64))  # contexts dealt over all buckets, by number: number, total, of counts 1, 2, more
    distinct: int = 0
    discount: np.ndarray = field(default_factory=lambda: discounts([0] * 4))


@dataclass
class Model:
    """Where the arrays are, and the few numbers that aren't in them."""

    folder: str
    bits: int
    order: int = 2
    words: int = 0
    tokens: int = 0
    freed: float = 1.0
    levels: dict[int, Level] = field(default_factory=dict)  # by length

    def word_bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    @property
    def shift(self) -> np.uint64:
        return np.uint64(self.words.bit_length())

    def keys(self, k: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of n-grams of length ``k``, given by numbers of their first k - 1 words and of the last."""
        if self.levels[k - 1].distinct.bit_length() + int(self.shift) > 64:
            raise OverflowError(f"{self.levels[k - 1].distinct} contexts and {self.words} words don't fit 64-bit keys")
        return context.astype(np.uint64) << self.shift | word.astype(np.uint64)

    def apart(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and last word of keys."""
        return (keys >> self.shift).astype(np.int64), (keys & ((np.uint64(1) << self.shift) - np.uint64(1))).astype(np.int64)

    def bucket(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Of sorted keys: by context, so that a context's statistics are made in one place; n-grams of top contexts by key."""
        context = keys >> self.shift
        first = ha.run_starts(context)
        size = np.diff(np.append(first, len(keys)))
        top, _ = self.at_top(k, context[first].astype(np.int64))
        out = np.repeat(self.word_bucket(ta.mix(context[first])), size)
        rows = np.flatnonzero(np.repeat(top, size))
        out[rows] = self.word_bucket(ta.mix(keys[rows]))
        return out

    def at_top(self, k: int, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each context is dealt over all buckets, and its place among those if it is."""
        place, top = _at(self.levels[k].top[:, 0], contexts)
        return top, place

    def holder(self, k: int, numbers: np.ndarray) -> np.ndarray:
        """The bucket of each n-gram, by its number."""
        return np.searchsorted(self.levels[k].base, numbers.astype(np.int64), "right") - 1

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1 if unknown) and count of each word."""
        bucket = self.word_bucket(hashes)
        place, count = ha.lookup(self.folder, "w", bucket, hashes, ("counts",))
        return np.where(place >= 0, place + self.levels[1].base[bucket], -1), count

    def runs(self, keys: np.ndarray) -> dict[str, np.ndarray]:
        """Sorted keys as arrays: each context once, where its run of words begins (and the last ends), and the words."""
        context, word = self.apart(keys)
        first = ha.run_starts(context)
        return {"contexts": ha._narrow(context[first]), "starts": ha._narrow(np.append(first, len(keys))), "words": ha._narrow(word)}

    def counts(self, k: int, bucket: int) -> dict[str, np.ndarray]:
        """The file of a bucket's counts, in the order of its n-grams."""
        return ha.get(self.folder, f"{'g' if k == self.order else 'n'}{k}-{bucket:06d}")

    def after(self, k: int, who: np.ndarray, first: np.ndarray, words: np.ndarray, scored: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different n-grams of length ``k`` by context: those of context ``who[g]``, all different, begin at ``first[g]``, with ascending last ``words``.

        The number of each (-1 if unknown, as where the context or word is); if ``scored``, its count, and of each context the total and what discounts
        set free (0 of unknown ones).  All of a bucket's n-grams lie together before its file is looked at, in the order of the file.
        """
        number, count = np.full(len(words), -1, np.int64), np.zeros(len(words) * scored, np.int64)
        total, freed = np.zeros(len(who) * scored, np.int64), np.zeros(len(who) * scored)
        groups = np.flatnonzero(who >= 0)
        if not len(groups):
            return number, count, total, freed
        if (np.diff(who[groups]) < 0).any():
            groups = groups[np.argsort(who[groups])]
        contexts, size = who[groups], np.diff(np.append(first, len(words)))[groups]
        rows = _spread(first[groups], size)
        top, place = self.at_top(k, contexts)
        group = np.repeat(np.arange(len(groups)), size)
        bucket = np.repeat(self.word_bucket(ta.mix(contexts.astype(np.uint64))), size)
        dealt = np.flatnonzero(top[group])
        bucket[dealt] = self.word_bucket(ta.mix(self.keys(k, contexts[group[dealt]], words[rows[dealt]])))
        order = np.argsort(ha._narrow(bucket), kind="stable")
        bucket, group, rows = bucket[order], group[order], rows[order]
        wanted, at, n = words[rows], np.full(len(rows), -1, np.int64), np.zeros(len(rows) * scored, np.int64)
        begins = ha.run_starts(bucket)  # rows of each bucket
        fresh = group[1:] != group[:-1]
        fresh[begins[1:] - 1] = True
        entry = np.concatenate([[0], np.flatnonzero(fresh) + 1])  # rows of each context in each bucket
        size, group = np.diff(np.append(entry, len(rows))), group[entry]
        contexts = contexts[group]
        summed = np.zeros((4, len(entry) * scored), np.int64)
        entries = np.append(np.searchsorted(entry, begins), len(entry))
        ends = np.append(begins[1:], len(rows))
        for b, i, j, e, f in zip(bucket[begins].tolist(), begins.tolist(), ends.tolist(), entries[:-1].tolist(), entries[1:].tolist(), strict=True):
            runs = ha.get(self.folder, f"g{k}-{b:06d}")
            start, end = _run(runs, contexts[e:f])
            here = _within(runs["words"], np.repeat(start, size[e:f]), np.repeat(end, size[e:f]), wanted[i:j])
            hit = np.flatnonzero(here >= 0)
            at[i:j][hit] = here[hit] + (self.levels[k].base[b] if k < self.order else 0)
            if scored:
                counts = runs if k == self.order else self.counts(k, b)
                n[i:j][hit] = ha.unescaped(counts, here[hit])
                summed[:, e:f] = self.run_sums(k, b, counts, contexts[e:f], start, end)
        number[rows] = at
        if scored:
            count[rows] = n
            d = self.levels[k].discount
            for to, sums in ((groups[group], summed), (groups[top], self.levels[k].top[place[top], 1:].T)):
                total[to], freed[to] = sums[0], d[1] * sums[1] + d[2] * sums[2] + d[3] * sums[3]
        return number, count, total, freed

    def run_sums(self, k: int, bucket: int, counts: dict[str, np.ndarray], contexts: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Total of each context's run of counts, and how many are 1, 2 and more: stored for long ones, made from the counts of others.

        Of the contexts that lie in all buckets the long runs have none.
        """
        out, size = np.zeros((4, len(contexts)), np.int64), end - start
        short, long = np.flatnonzero((size > 0) & (size <= LONG)), np.flatnonzero(size > LONG)
        if len(short):
            size = size[short]
            first = np.cumsum(size) - size
            places = _spread(start[short], size)
            c = counts["counts"][places]
            packed = np.add.reduceat(_PACKED[c], first)
            large = np.flatnonzero(c == 255)
            out[0, short] = packed & 0xFFFFFFFF
            if len(large):
                np.add.at(out[0], short[np.searchsorted(first, large, "right") - 1], ha.unescaped(counts, places[large]) - 255)
            for n in (1, 2, 3):
                out[n, short] = packed >> (24 + 8 * n) & 0xFF
        if len(long):
            stored = ha.get(self.folder, f"c{k}-{bucket:06d}")
            place, here = _at(stored["keys"], contexts[long].astype(np.uint64))
            for n, name in enumerate(("total", "one", "two", "more")):
                out[n, long[here]] = stored[name][place[here]]
        return out

    def found(self, k: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Number (-1 if unknown) of each n-gram of length ``k``, given by numbers of its first k - 1 words and of the last."""
        if not len(word):
            return np.zeros(0, np.int64)
        contexts, c, _ = ha.distinct(context)
        words, w, _ = ha.distinct(word)
        pairs, inverse, _ = ha.distinct(c * len(words) + w)
        c, w = np.divmod(pairs, len(words))
        first = ha.run_starts(c)
        return self.after(k, contexts[c[first]], first, words[w])[0][inverse]

    def ngrams(self, k: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and last word of the n-grams of these numbers."""
        context, word = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        for b, some in _by_value(self.holder(k, numbers)):
            runs = ha.get(self.folder, f"g{k}-{b:06d}")
            at = numbers[some] - self.levels[k].base[b]
            context[some] = runs["contexts"][np.searchsorted(runs["starts"], at.astype(runs["starts"].dtype), "right") - 1]
            word[some] = runs["words"][at]
        return context, word

    def without_first(self, k: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The number of the last k - 1 words of each n-gram of length ``k``; all of them were counted."""
        if k == 2:
            return word
        first = ha.run_starts(context)
        unique = context[first]
        shorter = np.full(len(unique), self.levels[k - 2].distinct, np.int64)  # starts alone stay so
        rest = unique < self.levels[k - 1].distinct
        if rest.any():
            shorter[rest] = self.without_first(k - 1, *self.ngrams(k - 1, unique[rest]))
        return self.found(k - 1, np.repeat(shorter, np.diff(np.append(first, len(context)))), word)


def _at(there: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each in a sorted array, and whether it is there."""
    if not len(there):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(there, wanted), len(there) - 1)
    return place, there[place] == wanted


#: What a count below 255, or the mark of a larger one, adds to a total (32 bits) and to the numbers of counts of 1, 2 and more (8 bits each) of a short run.
_PACKED = np.arange(256, dtype=np.int64) + np.array([0, 1 << 32, 1 << 40] + [1 << 48] * 253, np.int64)


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size`` places from each start on, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _by_value(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each of ``values`` with its places."""
    values = ha._narrow(values)
    order = np.argsort(values, kind="stable")
    first = ha.run_starts(values[order])
    return zip(values[order[first]].tolist(), np.split(order, first[1:]) if len(order) else [], strict=True)


def _run(runs: dict[str, np.ndarray], contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the run of each context begins and ends: nowhere if it has none."""
    there, starts = runs["contexts"], runs["starts"]
    if not len(there):
        return np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.int64)
    at = np.minimum(np.searchsorted(there, contexts.astype(there.dtype)), len(there) - 1)
    start = starts[at].astype(np.int64)
    return start, np.where(there[at] == contexts, starts[at + 1].astype(np.int64), start)


def _within(words: np.ndarray, start: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted word in its own sorted run; -1 where it isn't there."""
    out = np.full(len(wanted), -1, np.int64)
    if not len(words):
        return out
    kind, at = wanted.astype(words.dtype), start.copy()
    rows = np.flatnonzero(end - start > 1)
    low, size, w = start[rows], (end - start)[rows], kind[rows]
    while len(rows):
        half = size >> 1
        middle = low + half
        low = np.where(words[middle] <= w, middle, low)
        size -= half
        open_ = size > 1
        left = np.count_nonzero(open_)
        if 2 * left <= len(rows):
            at[rows] = low
            rows, low, size, w = rows[open_], low[open_], size[open_], w[open_]
    hit = np.flatnonzero((start < end) & (kind == wanted))
    hit = hit[words[at[hit]] == kind[hit]]
    out[hit] = at[hit]
    return out


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end, and each text's first token."""
    h, bounds = ta.word_hashes(data, offsets)
    n = len(offsets) - 1
    out = np.full(len(h) + n, END, np.uint64)
    out[np.arange(len(h)) + np.repeat(np.arange(n), np.diff(bounds))] = h
    return out, bounds + np.arange(n + 1)


def _grouped(batches: Iterator[pa.RecordBatch], text: int = 0) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Texts of a task in groups of some ``TOKENS``: the first column of each, the tokens, and each text's first token."""
    first, tokens, sizes, n = [], [], [], 0
    for batch in batches:
        for start, end, data, offsets in ta.parts(batch.column(text), HASHED):
            t, bounds = _tokens(data, offsets)
            first.append(batch.column(0).slice(start, end - start))
            tokens.append(t)
            sizes.append(np.diff(bounds))
            n += len(t)
            if n >= TOKENS:
                yield pa.concat_arrays(first), np.concatenate(tokens), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
                first, tokens, sizes, n = [], [], [], 0
    if n:
        yield pa.concat_arrays(first), np.concatenate(tokens), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def _numbered(model: Model, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number (-1 if unknown) and count of each different token, and which of these each token is."""
    unique, inverse, _ = ha.distinct(tokens)
    return *model.numbers(unique), inverse


def _before(there: np.ndarray, bounds: np.ndarray, start: int) -> np.ndarray:
    """What stands before each token: the n-gram that ends with the token before it, or ``start`` at a text's first."""
    before = np.empty_like(there)
    before[1:] = there[:-1]
    before[bounds[:-1]] = start
    return before


@dataclass
class _Grams:
    """The different n-grams of one length in a group of texts."""

    number: np.ndarray  # of each; -1 is unknown
    of: np.ndarray  # which of these ends with each token
    token: np.ndarray  # a token that each ends with
    count: np.ndarray
    context: np.ndarray  # which context each has
    total: np.ndarray  # of each context
    freed: np.ndarray

    @classmethod
    def longer(cls, model: Model, k: int, shorter: _Grams, words: np.ndarray, word: np.ndarray, bounds: np.ndarray, scored: bool = False) -> _Grams:
        """Of length ``k``, from those one word shorter and the words: their numbers, and which of them each token is."""
        numbers = np.append(shorter.number, model.levels[k - 1].distinct)  # the last: starts alone
        pairs, of, token = ha.distinct(_before(shorter.of, bounds, len(numbers) - 1) * len(words) + word)
        context, w = np.divmod(pairs, len(words))
        first = ha.run_starts(context)
        number, count, total, freed = model.after(k, numbers[context[first]], first, words[w], scored)
        return cls(number, of, token, count, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(pairs)))), total, freed)


def _alone(numbers: np.ndarray, of: np.ndarray) -> _Grams:
    """Words as n-grams of length 1."""
    nothing = np.zeros(0, np.int64)
    return _Grams(numbers, of, nothing, nothing, nothing, nothing, nothing)


def _texts(frame: DataFrame, text: str) -> DataFrame:
    return frame.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def train(documents: DataFrame, text: str = "text", order: int = 2) -> Model:
    """Count ``documents`` into arrays in the shared folder; contexts have ``order`` - 1 words."""
    if order < 2:
        raise ValueError(f"order {order} is below 2")
    spark = documents.sparkSession
    small_batches(spark)
    texts = _texts(documents, text)
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    model = Model(new_folder(spark, "kneser-ney"), ha.bucket_bits(spark, n_bytes), order)
    buckets = 1 << model.bits
    made = "bucket long, n long, total long, place array<long>, count array<long>"

    def described(bucket: int, counts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        """Size and total of a bucket, and the most frequent of its ``ids``."""
        most = np.argsort(counts)[-16:]
        return pa.RecordBatch.from_pydict({"bucket": [bucket], "n": [len(counts)], "total": [int(counts.sum())], "place": [ids[most].tolist()], "count": [counts[most].astype(np.int64).tolist()]}, _MADE)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ha.Counter(model.word_bucket)
        for batch in batches:
            for _, _, data, offsets in ta.parts(batch.column(0), HASHED):
                yield from counter.add(_tokens(data, offsets)[0])
        yield from counter.flush()

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys, counts in ha.by_bucket(batches):
            ha.put(model.folder, f"w{bucket:06d}", {"keys": keys, "counts": ha._narrow(counts)})
            yield described(bucket, counts, np.arange(len(counts)))

    def count_grams(k: int) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counter = ha.Counter(lambda keys: model.bucket(k, keys))
            for _, tokens, bounds in _grouped(batches):
                numbers, _, of = _numbered(model, tokens)
                grams = _alone(numbers, of)
                for j in range(2, k):
                    grams = _Grams.longer(model, j, grams, numbers, of, bounds)
                ends = np.append(grams.number, model.levels[k - 1].distinct)[_before(grams.of, bounds, len(grams.number))]
                yield from counter.add(model.keys(k, ends, numbers[of]))
            yield from counter.flush()

        return ha.merged(texts.mapInArrow(work, ha.BLOBS), buckets)

    def write_grams(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, keys, counts in ha.by_bucket(batches):
                ha.put(model.folder, f"g{k}-{bucket:06d}", model.runs(keys))
                yield described(bucket, counts, np.arange(len(counts)))

        return work

    def number(k: int, rows: list) -> None:
        """Numbers of a level's n-grams, and which of them are frequent enough as contexts of the next to be dealt over all buckets."""
        size = np.zeros(buckets, np.int64)
        for r in rows:
            size[r.bucket] = r.n
        level = model.levels.setdefault(k, Level())
        level.base, level.distinct, total = np.concatenate([[0], np.cumsum(size)]), int(size.sum()), sum(r.total for r in rows)
        if k == 1:
            model.words, model.tokens = level.distinct, total
        top = [int(level.base[r.bucket] + p) for r in rows for p, c in zip(r["place"], r["count"], strict=True) if c * 4 * buckets >= total]
        following = model.levels.setdefault(k + 1, Level())
        following.top = np.zeros((len(top) + 1, 5), np.int64)
        following.top[:, 0] = sorted([*top, level.distinct])

    number(1, ha.merged(texts.mapInArrow(count_words, ha.BLOBS), buckets).mapInArrow(write_words, made).collect())
    for k in range(2, order):
        number(k, count_grams(k).mapInArrow(write_grams(k), made).collect())

    def summed_up(k: int, bucket: int, keys: np.ndarray, counts: np.ndarray) -> None:
        """A bucket's contexts of many words, its counts of counts, and its share of the contexts that lie in all buckets."""
        context, _ = model.apart(keys)
        first = ha.run_starts(context)
        sums = [np.add.reduceat(x.astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for x in (counts, counts == 1, counts == 2, counts > 2)]
        who = context[first]
        wide = np.isin(who, model.levels[k].top[:, 0])
        long = ~wide & (np.diff(np.append(first, len(keys))) > LONG)
        ha.put(model.folder, f"c{k}-{bucket:06d}", {"keys": who[long].astype(np.uint64)} | {f: ha._narrow(s[long]) for f, s in zip(("total", "one", "two", "more"), sums, strict=True)})
        ha.put(model.folder, f"s{k}-{bucket:06d}", {"sizes": np.array([len(keys), *((counts == n).sum() for n in (1, 2, 3, 4))], np.int64), "wide": np.stack([who[wide], *(s[wide] for s in sums)], 1).ravel()})

    def slices(keys: np.ndarray) -> Iterator[np.ndarray]:
        return (keys[k : k + _AT_ONCE] for k in range(0, len(keys), _AT_ONCE))

    def write_highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ha.Counter(lambda numbers: model.holder(order - 1, numbers))
        for bucket, keys, counts in ha.by_bucket(batches):
            ha.put(model.folder, f"g{order}-{bucket:06d}", model.runs(keys) | ha.escaped(counts))
            summed_up(order, bucket, keys, counts)
            for some in slices(keys):
                yield from counter.add(model.without_first(order, *model.apart(some)).astype(np.uint64))
        yield from counter.flush()

    def continued(k: int, bucket: int, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How many tokens stand before each n-gram of the bucket."""
        base = model.levels[k].base
        dense = np.zeros(int(base[bucket + 1] - base[bucket]), np.uint64)
        dense[keys.astype(np.int64) - base[bucket]] = counts
        ha.put(model.folder, f"n{k}-{bucket:06d}", ha.escaped(dense))
        return dense

    def write_between(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counter = ha.Counter(lambda numbers: model.holder(k - 1, numbers))
            for bucket, numbers, counts in ha.by_bucket(batches):
                runs = ha.get(model.folder, f"g{k}-{bucket:06d}")
                keys = model.keys(k, np.repeat(runs["contexts"], np.diff(runs["starts"])), runs["words"])
                summed_up(k, bucket, keys, continued(k, bucket, numbers, counts))
                for some in slices(keys):
                    yield from counter.add(model.without_first(k, *model.apart(some)).astype(np.uint64))
            yield from counter.flush()

        return work

    def write_lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, numbers, counts in ha.by_bucket(batches):
            dense = continued(1, bucket, numbers, counts)
            yield pa.RecordBatch.from_pydict({f"n{k}": [int((dense == k).sum() if k < 5 else (dense > 2).sum())] for k in range(1, 6)})

    before = count_grams(order).mapInArrow(write_highest, ha.BLOBS)
    for k in range(order - 1, 1, -1):
        before = ha.merged(before, buckets).mapInArrow(write_between(k), ha.BLOBS)
    lowest = ha.merged(before, buckets).mapInArrow(write_lowest, "n1 long, n2 long, n3 long, n4 long, n5 long").collect()

    for k in range(2, order + 1):
        level, sizes = model.levels[k], np.zeros(5, np.int64)
        for bucket in range(buckets):
            found = ha.get(model.folder, f"s{k}-{bucket:06d}")
            sizes += found["sizes"]
            wide = found["wide"].reshape(-1, 5)
            level.top[np.searchsorted(level.top[:, 0], wide[:, 0]), 1:] += wide[:, 1:]
        level.distinct, level.discount = int(sizes[0]), discounts(sizes[1:].tolist())
    n = [sum(r[k] for r in lowest) for k in range(5)]
    d = model.levels[1].discount = discounts(n[:4])
    if model.levels[2].distinct:
        model.freed = float(d[1] * n[0] + d[2] * n[1] + d[3] * n[4]) / model.levels[2].distinct
    return model


def _lowest(model: Model, words: np.ndarray) -> np.ndarray:
    """Of each different word, whatever stands before it; -1 is unknown."""
    known = words >= 0
    out = np.full(len(words), model.freed / (model.words + 1))
    if known.any():
        there = words[known]
        n = np.zeros(len(there), np.int64)
        for b, some in _by_value(model.holder(1, there)):
            n[some] = ha.unescaped(model.counts(1, b), there[some] - model.levels[1].base[b])
        out[known] += (n - model.levels[1].discount[np.minimum(n, 3)]) / model.levels[2].distinct
    return out


def _probabilities(model: Model, numbers: np.ndarray, of: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each different n-gram of the model's order, and which of these ends with each token."""
    out, grams = _lowest(model, numbers), _alone(numbers, of)
    for k in range(2, model.order + 1):
        shorter, d = grams.of, model.levels[k].discount
        grams = _Grams.longer(model, k, grams, numbers, of, bounds, True)
        free = np.where(grams.total > 0, grams.freed / np.maximum(grams.total, 1), 1.0)
        out = out[shorter[grams.token]] * free[grams.context]
        total = grams.total[grams.context]
        seen = np.flatnonzero(total > 0)
        c = grams.count[seen]
        out[seen] += (c - d[np.minimum(c, 3)]) / total[seen]
    return out, grams.of


def score(documents: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``documents``: its id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity``.

    Null and empty texts have one token, their end.
    """
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # numbers by bucket; some kilobytes

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for ids, tokens, bounds in _grouped(batches, 1):
            numbers, count, of = _numbered(m, tokens)
            size = np.diff(bounds)
            p, grams = _probabilities(m, numbers, of, bounds)
            base = np.log10((count.astype(np.float64) + 1) / (m.tokens + m.words + 1))
            first = bounds[:-1]
            total = np.add.reduceat(np.log10(p)[grams], first)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(size), pa.array(np.add.reduceat((count > 0).astype(np.int64)[of], first)), pa.array(np.full(len(size), m.tokens)), pa.array(np.add.reduceat(base[of], first)), pa.array(total), pa.array(10 ** np.minimum(300, -total / size))],
                names=[id, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    kind = documents.schema[id].dataType.simpleString()
    frame = documents.select(id, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return frame.mapInArrow(scored, f"`{id}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
