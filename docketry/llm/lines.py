"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

Lines are compared as their lower-cased words.  Two lines are duplicates when
their words are equal or, for lines of ``min_words`` words and more, one word is
changed, added or left out (an edit distance of 1 over words; in a shorter line
one edit changes most of it).  A line goes if an earlier line, by (doc_id, text
hash, line number), duplicates it; the earliest stays.  Blank lines stay.

Equal lines meet by hash.  An edit touches the first or the last half of a
line, so lines within one edit share a run of words at one end; only lines
whose run recurs in another line have candidates, and nearly no lines of
ordinary text do.  Of these the words outside the run emit as hashed keys, within
that run, themselves and all variants with one word left out; lines with equal keys
are candidates, the earliest of each key is compared with the rest, and the
edit distance of these pairs is verified on the words.

Null texts stay null and have no lines.  Rows with the same doc_id and text
count as one document: what one loses the other loses.  Null doc_ids sort first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, join_counted, written

_BLOCK = 64


def normal(line: Column) -> Column:
    """A line's lower-cased words, parted by single spaces."""
    untidy = [F.contains(line, F.lit(x)) for x in ("  ", "\t", "\x0b", "\x0c", "\r")] + [F.startswith(line, F.lit(" ")), F.endswith(line, F.lit(" "))]
    some = untidy[0]
    for u in untidy[1:]:
        some = some | u
    return F.lower(F.when(some, F.trim(F.regexp_replace(line, r"[ \t\x0B-\x0D]+", " "))).otherwise(line))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running_xor(a: Column) -> Column:
    """For each element, the xor of those before it.  Two levels, so that long arrays take no quadratic time."""
    zero = F.array(F.lit(0).cast("long"))

    def step(done: Column, x: Column) -> Column:
        return F.concat(done, F.array(F.element_at(done, -1).bitwiseXOR(x)))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")), lambda b: F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK)))
    inner = F.transform(blocks, lambda block: F.aggregate(block, zero, step))

    def shifted(inner: Column, outer: Column) -> Column:
        return F.flatten(F.transform(inner, lambda x, b: _let(F.get(outer, b), lambda o: F.transform(F.slice(x, 1, F.size(x) - 1), lambda y: y.bitwiseXOR(o)))))

    return _let(inner, lambda inner: _let(F.aggregate(F.transform(inner, lambda x: F.element_at(x, -1)), zero, step), lambda outer: shifted(inner, outer)))


def edit_distance_at_most_one(a: Column, b: Column) -> Column:
    """Whether at most one word must be changed, added or left out to get from one array to the other."""

    def common(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q)), True)
        return F.when(differs == 0, F.least(F.size(x), F.size(y))).otherwise(differs - 1)

    return common(a, b) + common(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def run_length(n: Column) -> Column:
    """Words at an end by which a line of ``n`` words is looked up: half of them, rounded down to its three leading bits.

    Lines of n and of n - 1 words mostly share it; the longer has a second key where they don't.
    """
    half = F.floor(n / 2).cast("int")
    step = F.lit(1)
    for bits in range(3, 31):
        step = F.when(half >= 1 << bits, 1 << (bits - 2)).otherwise(step)
    return (half - half % step).cast("int")


def _ends(line: Column, words: Column) -> list[Column]:
    """Hashes of the first and of the last ``words`` words."""
    return [F.xxhash64(words, F.lit(side), F.call_function("substring_index", line, F.lit(" "), count)) for side, count in (("first", words), ("last", -words))]


def dedup_lines(documents: DataFrame, min_words: int = 4) -> DataFrame:
    """``documents`` without the lines that an earlier line duplicates.

    ``text`` has what stays, joined by newlines; ``n_lines`` and ``n_dropped``
    (replaced if there already) count the lines before and those gone.  The
    number and order of other columns, and all rows, stay.
    """
    columns = documents.columns
    hash_, id_, h_, gone_ = fresh(documents, "_hash", "_id", "_h", "_gone")
    keyed = documents.withColumn(hash_, F.xxhash64("text"))
    whole = keyed.filter(F.col("text").isNotNull()).select(F.col("doc_id").alias("doc_id"), F.col(hash_).alias("hash"), "text")
    lines = whole.select("doc_id", "hash", F.posexplode(F.split("text", "\n")).alias("no", "line")).select("doc_id", "hash", "no", normal(F.col("line")).alias("line"))
    lines = lines.filter("line <> ''").withColumn("n", (F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1).cast("int"))
    lines = lines.withColumns({"own": run_length(F.col("n")), "less": run_length(F.col("n") - 1)})
    near_too, second = F.col("n") >= min_words, (F.col("n") > min_words) & (F.col("own") != F.col("less"))
    ends = {f"e{k}": F.when(near_too if k < 2 else second, e) for k, e in enumerate([*_ends(F.col("line"), F.col("own")), *_ends(F.col("line"), F.col("less"))])}
    occurrences = written(lines.select("doc_id", "hash", "no", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"), *(e.alias(k) for k, e in ends.items())), "lines")
    total = occurrences.count()
    place = F.struct("doc_id", "hash", "no")
    distinct = occurrences.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count("*").alias("c"), *(F.min(k).alias(k) for k in ends))
    distinct = written(distinct, "distinct-lines")

    # near duplicates
    runs = distinct.select("k1", "k2", "first", F.posexplode(F.array(*ends)).alias("side", "run")).filter("run is not null")
    again = written(runs.groupBy("run").agg(F.count("*").alias("c")).filter("c > 1"), "runs")
    chosen = join_counted(runs, again, ["run"], total).groupBy("k1", "k2", "first").agg(F.collect_list(F.struct("side", "run")).alias("runs"))
    candidates = written(_words(whole, written(chosen, "candidates")), "candidate-lines")
    near = written(_earlier_partner(candidates, total), "near")

    # what goes: all but the first of equal lines, and every line with an earlier near duplicate
    repeated = distinct.join(near.withColumn("near", F.lit(True)).hint("merge"), ["k1", "k2"], "left").filter("near or c > 1").select("k1", "k2", "first", "near", "c")
    gone = join_counted(occurrences.select("doc_id", "hash", "no", "k1", "k2"), written(repeated, "repeated"), ["k1", "k2"], total)
    gone = gone.filter(F.coalesce("near", F.lit(False)) | (place != F.col("first")))
    gone = gone.groupBy("doc_id", "hash").agg(F.collect_set("no").alias(gone_)).select(F.col("doc_id").alias(id_), F.col("hash").alias(h_), gone_)
    joined = keyed.join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(h_)), "left")
    parts = F.split("text", "\n")

    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone_))
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    result = joined.withColumns(  # all three from the text as it came
        {
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)),
            "n_dropped": F.coalesce(F.size(gone_), F.lit(0)),
            "text": F.when(F.col(gone_).isNull(), F.col("text")).otherwise(_let(parts, kept)),
        }
    )
    return result.select(*columns, *(c for c in ("n_lines", "n_dropped") if c not in columns))


def _words(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Candidates (k1, k2, place, runs) with their words, each text split once."""
    wanted = chosen.select(F.col("first.doc_id").alias("id"), F.col("first.hash").alias("h"), F.struct("k1", "k2", F.col("first").alias("place"), "runs").alias("c"))
    wanted = wanted.groupBy("id", "h").agg(F.collect_list("c").alias("cs"))
    # a join of all sizes by a shuffle: what is wanted grows with the texts
    found = texts.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h")))
    lines = F.split("text", "\n")
    taken = found.select(F.explode(_let(lines, lambda lines: F.transform("cs", lambda c: F.struct(c.alias("c"), F.get(lines, c["place"]["no"]).alias("line"))))).alias("x"))
    taken = taken.select("x.c.*", F.split(normal(F.col("x.line")), " ").alias("words"))
    return taken.dropDuplicates(["k1", "k2"])  # rows with the same doc_id and text


def _earlier_partner(candidates: DataFrame, total: int) -> DataFrame:
    """Of ``candidates`` (k1, k2, place, runs, words), the keys of those with an earlier one within one edit."""
    each = candidates.select("k1", "k2", "place", "words", F.explode("runs").alias("r")).select("k1", "k2", "place", "words", "r.side", "r.run")
    n = F.size("words")
    length = F.when(F.col("side") < 2, run_length(n)).otherwise(run_length(n - 1))
    rest = F.when(F.col("side") % 2 == 0, F.slice("words", length + 1, n - length)).otherwise(F.slice("words", F.lit(1), n - length))
    each = each.select("k1", "k2", "place", "run", rest.alias("rest")).withColumn("n", F.size("rest"))
    here = F.transform("rest", lambda w, i: F.xxhash64(w, i))
    moved = F.transform("rest", lambda w, i: F.xxhash64(w, i - 1))
    arrays = each.select("k1", "k2", "place", "run", "n", here.alias("here"), moved.alias("moved"))
    arrays = arrays.withColumns({"before": _running_xor(F.col("here")), "moved_before": _running_xor(F.col("moved"))})

    def all_of(a: str) -> Column:
        return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))

    arrays = written(arrays.withColumns({"whole": all_of("here"), "moved_whole": all_of("moved")}), "running")
    # without word i: what is before it as it stands, what is after it one place to the left; -1 is the rest itself
    without = F.transform(
        F.sequence(F.lit(-1), F.col("n") - 1),
        lambda i: F.struct(
            i.alias("i"),
            F.when(i < 0, F.col("whole"))
            .otherwise(F.get("before", i).bitwiseXOR(F.col("moved_whole")).bitwiseXOR(F.get("moved_before", i)).bitwiseXOR(F.get("moved", i)))
            .alias("x"),
        ),
    )
    emitted = arrays.select("k1", "k2", "place", "run", "n", F.explode(without).alias("v"))
    key = F.xxhash64("run", F.when(F.col("v.i") < 0, F.col("n")).otherwise(F.col("n") - 1), "v.x")
    emitted = written(emitted.select("k1", "k2", "place", key.alias("key"), F.col("v.i").alias("i")), "variants")
    # few keys have more than one line; those keys alone meet their lines again
    keys = emitted.groupBy("key").agg(F.count("*").alias("c"), F.min("k1").alias("low"), F.max("k1").alias("high")).filter("low <> high").select("key", "c")
    shared = written(join_counted(emitted, written(keys, "shared-keys"), ["key"], total), "shared-variants")
    earliest = F.min(F.struct("place", "k1", "k2")).alias("partner")
    changed = shared.filter("i >= 0").groupBy("key", "i").agg(earliest, F.count("*").alias("c")).filter("c > 1")  # the same place left out
    shorter = shared.filter("i < 0").groupBy("key").agg(earliest, F.count("*").alias("c"))
    longer = shared.filter("i >= 0").groupBy("key").agg(earliest, F.count("*").alias("c"))
    lines = shared.drop("c")
    pairs = (
        join_counted(lines, changed, ["key", "i"], total)
        .unionByName(join_counted(lines.filter("i >= 0"), shorter, ["key"], total))
        .unionByName(join_counted(lines.filter("i < 0"), longer, ["key"], total))
        .filter(F.col("partner.place") < F.col("place"))
        .select("k1", "k2", F.col("partner.k1").alias("p1"), F.col("partner.k2").alias("p2"))
        .distinct()
    )
    mine = candidates.select("k1", "k2", "words")
    theirs = candidates.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("words").alias("theirs"))
    verified = pairs.join(mine, ["k1", "k2"]).join(theirs, ["p1", "p2"]).filter(edit_distance_at_most_one(F.col("words"), F.col("theirs")))
    return verified.select("k1", "k2").distinct()


#: The same by brute force over lines that share a half, for DuckDB.
SQL = """
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS no
  FROM documents WHERE text IS NOT NULL
), worded AS (
  SELECT doc_id, no, list_filter(string_split_regex(lower(line), '[ \\t\\x0B-\\x0D]+'), lambda x: x <> '') AS words
  FROM lines
), long AS (SELECT doc_id, no, words, len(words) AS n FROM worded WHERE len(words) > 0
), firsts AS (
  SELECT words, n, min((doc_id, no)) AS place FROM long GROUP BY words, n
), halves AS (
  SELECT words, n, place, m, 'first' AS side, words[1:m // 2] AS half FROM firsts, (VALUES (0), (1)) AS d(k), LATERAL (SELECT n - k AS m) WHERE n >= 4
  UNION ALL
  SELECT words, n, place, m, 'second', words[n - (m - m // 2) + 1:n] FROM firsts, (VALUES (0), (1)) AS d(k), LATERAL (SELECT n - k AS m) WHERE n >= 4
), pairs AS (
  SELECT DISTINCT a.words AS words, b.words AS other
  FROM halves a JOIN halves b ON a.m = b.m AND a.side = b.side AND a.half = b.half AND b.place < a.place AND abs(a.n - b.n) <= 1
), measured AS (
  SELECT words,
    coalesce(list_min(list_filter(range(least(len(words), len(other))), lambda i: words[i + 1] <> other[i + 1])), least(len(words), len(other))) AS head,
    coalesce(list_min(list_filter(range(least(len(words), len(other))), lambda i: words[len(words) - i] <> other[len(other) - i])), least(len(words), len(other))) AS tail,
    greatest(len(words), len(other)) AS longest
  FROM pairs
), near AS (SELECT DISTINCT words FROM measured WHERE head + tail >= longest - 1
), gone AS (
  SELECT l.doc_id, l.no FROM long l JOIN firsts f ON l.words = f.words
  WHERE (l.doc_id, l.no) <> f.place OR l.words IN (SELECT words FROM near)
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (g.no IS NOT NULL) AS n_dropped,
         string_agg(l.line, chr(10) ORDER BY l.no) FILTER (g.no IS NULL) AS kept
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.no = g.no GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0)::INT AS n_lines, coalesce(k.n_dropped, 0)::INT AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.kept, '')) END AS text_md5
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
