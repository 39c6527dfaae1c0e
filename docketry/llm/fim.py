"""Fill-in-middle transformation of texts held as ropes.

A rope is a binary tree over a text's pieces.  Its leaves keep their piece, the
number of units in it (code points, words or lines) and the number of code
points; inner nodes keep the sums.  To split a rope at a rank of units one path
is walked down; to concatenate two, one node is made.  So a text of any length
is cut at two ranks and put together in another order without its pieces being
touched, but for the two leaves that are cut.

A text becomes prefix, middle and suffix; the middle goes to the end, behind
sentinels.  Inverting builds the output's rope, splits it where the sentinels
stand and puts the parts back into order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .shared import fresh, small_batches, tidy

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points of a leaf; one that ends inside a unit takes the rest of it too.
LEAF = 4096
#: A unit of each kind, and where the next one begins.  Words take the white space behind them; white space at a text's start is one of its own.
UNITS = {"word": (re.compile(r"\s+|\S+\s*"), re.compile(r"(?<=\s)(?=\S)")), "line": (re.compile(r"[^\n]*\n|[^\n]+"), re.compile(r"(?<=\n)"))}


@dataclass(frozen=True, slots=True)
class Leaf:
    text: str
    units: int
    points: int
    kind: str = "char"


@dataclass(frozen=True, slots=True)
class Node:
    left: Leaf | Node
    right: Leaf | Node
    units: int
    points: int


Rope = Leaf | Node


def leaf(text: str, kind: str = "char") -> Leaf:
    return Leaf(text, len(text) if kind == "char" else sum(1 for _ in UNITS[kind][0].finditer(text)), len(text), kind)


def concat(*ropes: Rope) -> Rope:
    """Neighbours in pairs, level by level; empty ones are left out."""
    level = [r for r in ropes if r.points] or [*ropes[:1], leaf("")][:1]
    while len(level) > 1:
        pairs = zip(level[::2], level[1::2], strict=False)
        level = [Node(a, b, a.units + b.units, a.points + b.points) for a, b in pairs] + level[len(level) & ~1 :]
    return level[0]


def rope(text: str, kind: str = "char", size: int = LEAF) -> Rope:
    """The rope of a text, its leaves cut between units."""
    pieces, at = [], 0
    while at < len(text):
        end = at + size
        if kind != "char" and end < len(text):
            following = UNITS[kind][1].search(text, end)
            end = following.start() if following else len(text)
        pieces.append(leaf(text[at:end], kind))
        at = end
    return concat(*pieces) if pieces else leaf("", kind)


def split(whole: Rope, units: int) -> tuple[Rope, Rope]:
    """What lies before and behind the first ``units`` units."""
    before, behind = [], []
    while isinstance(whole, Node):
        if units < whole.left.units:
            behind.append(whole.right)
            whole = whole.left
        else:
            before.append(whole.left)
            units -= whole.left.units
            whole = whole.right
    at = units
    if whole.kind != "char":
        ends = [0, *(m.end() for m in UNITS[whole.kind][0].finditer(whole.text))]
        at = ends[min(units, len(ends) - 1)]
    return concat(*before, leaf(whole.text[:at], whole.kind)), concat(leaf(whole.text[at:], whole.kind), *reversed(behind))


def string(whole: Rope) -> str:
    out, open_ = [], [whole]
    while open_:
        r = open_.pop()
        if isinstance(r, Node):
            open_ += (r.right, r.left)
        else:
            out.append(r.text)
    return "".join(out)


def arrange(text: str, h: tuple[int, int, int, int], kind: str = "char", plain_from: int = 90, spm_below: int = 20) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and output of a text, by four numbers."""
    whole = rope(text, kind)
    n = whole.units
    if not n or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= plain_from:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    rest, suffix = split(whole, b)
    prefix, middle = split(rest, a)
    p, s, m = leaf(PREFIX), leaf(SUFFIX), leaf(MIDDLE)
    if h[3] % 100 < spm_below:
        return n, "spm", prefix.points, middle.points, string(concat(s, suffix, p, prefix, m, middle))
    return n, "psm", prefix.points, middle.points, string(concat(p, prefix, s, suffix, m, middle))


def invert(output: str, form: str) -> str:
    """The text that was arranged; it holds no sentinel, so the second and third that are found are those put in."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    at = output.index(second, len(first))
    last = output.index(MIDDLE, at + len(second))
    rest, middle = split(rope(output), last)
    head, tail = split(rest, at)
    _, head = split(head, len(first))
    _, tail = split(tail, len(second))
    _, middle = split(middle, len(MIDDLE))
    return string(concat(head, middle, tail) if form == "psm" else concat(tail, middle, head))


def _numbers(id: Column, seed: int) -> list[Column]:
    """The first four groups of eight digits of the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    documents: DataFrame, id: str = "doc_id", text: str = "text", into: str = "fim", unit: str = "char", seed: int = 1, plain_from: int = 90, spm_below: int = 20
) -> DataFrame:
    """``documents`` with ``n`` (units of the whole text), ``form``, ``prefix_chars`` and ``middle_chars`` (code points) and ``into``.

    A hash of seed and id says where a text is cut, whether it stays ``plain``, and
    whether prefix or suffix comes first (``psm``, ``spm``).  Null and empty texts
    and those that hold a sentinel stay plain; plain ones have null counts, and a null
    text an empty output.  A null id is hashed as if it were empty, and rows with the
    same id and text get the same output.  Other columns are passed through; those
    named as a result are replaced.
    """
    if unit != "char" and unit not in UNITS:
        raise ValueError(f"unit {unit!r} is none of char, {', '.join(UNITS)}")
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    @F.arrow_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    @tidy
    def arranged(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *numbers in batches:
            h = list(zip(*(x.to_pylist() for x in numbers), strict=True))
            columns: list[list] = [[], [], [], [], []]
            for start, end, _, _ in ta.parts(texts):
                for k, t in enumerate(texts.slice(start, end - start).to_pylist(), start):
                    for column, value in zip(columns, arrange(t, h[k], unit, plain_from, spm_below), strict=True):
                        column.append(value)
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))

    small_batches(documents.sparkSession)
    (found,) = fresh(documents, "_fim")
    made = documents.withColumn(found, arranged(F.coalesce(F.col(text).cast("string"), F.lit("")), *_numbers(F.col(id), seed)))
    names = {"n": "n", "form": "form", "prefix_chars": "prefix_chars", "middle_chars": "middle_chars", into: "output"}
    return made.withColumns({name: F.col(found)[field] for name, field in names.items()}).drop(found)


def restore(arranged: DataFrame, output: str = "fim", form: str = "form", into: str = "restored") -> DataFrame:
    """``arranged`` with the text that each output was made of, by ``output`` and ``form`` alone; null where either is."""

    @F.arrow_udf("string")
    @tidy
    def restored(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            found: list[str | None] = []
            for start, end, _, _ in ta.parts(outputs):
                pairs = zip(outputs.slice(start, end - start).to_pylist(), forms.slice(start, end - start).to_pylist(), strict=True)
                found += [None if o is None or f is None else invert(o, f) for o, f in pairs]
            yield pa.array(found, pa.string())

    return arranged.withColumn(into, restored(F.col(output), F.col(form)))


SQL = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || doc_id) AS h FROM documents
), numbers AS (
  SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM hashed
), formed AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), cut AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""
