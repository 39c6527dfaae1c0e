"""Acts as provisions: boundaries with titles and context, small ones merged, large ones split by clause, sub-section or paragraph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import naming
from ..functions.classify import matches
from ..functions.redaction import _let
from ..functions.text import strip
from .chunking import BODY, CONTENTS, CONTENTS_LENGTH, FOOTNOTE_LINE
from .matches import match_table, places

# Boundaries of acts, each with its number as the only group, and priorities by type.
PATTERNS: dict[str, tuple[str, int]] = {
    "preamble": (r"(?mid)^(?:An\s+Act\s+to\b|STATEMENT\s+OF\s+OBJECTS\s+AND\s+REASONS)()", 1),
    "chapter_heading": (r"(?md)^(?:#{1,3}\s+)?(?:\*\*)?(?:CHAPTER|Chapter)\s+([IVXLCDM]+|\d+[A-Z]?)\b", 1),
    "part_heading": (r"(?md)^(?:#{1,3}\s+)?(?:\*\*)?(?:PART|Part)\s+([IVXLCDM]+|\d+[A-Z]?)\b", 1),
    "section": (r"(?md)^(?:>\s*)?(?:\d{1,3}\[\s*)?(?:\[\d{1,3}\]\s*)?(?:\*\*)?(\d+[A-Z]{0,2})\.\s", 1),
    "roman": (r"(?md)^([IVXLC]+)\.\s", 1),
    "article": (r"(?md)^(?:Article|Art\.?)\s+(\d+[A-Z]{0,2})\b", 1),
    "schedule": (r"(?mid)^(?:(?:THE\s+)?(FIRST|SECOND|THIRD|FOURTH|FIFTH|SIXTH|SEVENTH|EIGHTH|NINTH|TENTH|ELEVENTH|TWELFTH|\d+(?:ST|ND|RD|TH)?)\s+SCHEDULE\b|SCHEDULE\s*$)", 1),
}
PRIORITIES = {"definitions": 90, "section": 80, "article": 80, "schedule": 70, "preamble": 65, "short_title": 60, "amendment_provision": 55, "chapter_heading": 30, "part_heading": 30, "body": 30}
ORDINALS = "FIRST SECOND THIRD FOURTH FIFTH SIXTH SEVENTH EIGHTH NINTH TENTH ELEVENTH TWELFTH".split()
# What ends a section's title, tried in this order; how far it may stand, and how much counts without one.
TITLE_ENDS, TITLE_WITHIN, TITLE_REACH, TITLE_ELSE = [".—", ".--", ".-", "\n"], 200, 300, 100
HEADING_ELSE = 200
#: A repealed section says so and is shorter than this.
REPEALED, REPEALED_BELOW = r"(?i)\[(?:Omitted|Repealed|Rep\.)\s*(?:by\s+[^]]+)?\]", 300
# Clauses of definitions, sub-sections; sizes of pieces.
CLAUSE, SUB_SECTION = r"(?md)^\s*\(([a-z]{1,3}|[ivxlc]+)\)\s", r"(?md)^\s*\((\d+)\)\s"
SMALLEST, LARGEST = 80, 1500

HEADINGS = ["chapter_heading", "part_heading"]


def section_title(after: Column) -> Column:
    """The title of a section from what follows its number."""
    reach, title = F.substring(after, 1, TITLE_REACH), F.lit(None).cast("string")
    for end in reversed(TITLE_ENDS):
        at = F.instr(reach, F.lit(end)) - 1
        title = F.when((at >= 0) & (at < TITLE_WITHIN), F.substr(reach, F.lit(1), at)).otherwise(title)
    return F.regexp_replace(strip(F.coalesce(title, F.substring(reach, 1, TITLE_ELSE))), r"\.+$", "")


def heading_title(after: Column) -> Column:
    """The title of a chapter, part or schedule: the paragraph behind its number."""
    rest = F.regexp_replace(after, r"^[ \t\n\r]+", "")
    end = F.instr(rest, F.lit("\n\n")) - 1
    return strip(F.regexp_replace(strip(F.when(end >= 0, F.substr(rest, F.lit(1), end)).otherwise(F.substring(rest, 1, HEADING_ELSE))), r"^-+|-+$", ""))


def section_type(number: Column, title: Column) -> Column:
    lower = F.lower(title)
    return (
        F.when((number == "1") & (lower.contains("short title") | lower.contains("extent")), "short_title")
        .when(lower.contains("definition") | lower.contains("interpretation"), "definitions")
        .when(lower.contains("amendment") & lower.contains("act"), "amendment_provision")
        .otherwise("section")
    )


def _schedule_number(said: Column) -> Column:
    upper, out = F.upper(said), F.coalesce(F.regexp_substr(said, F.lit(r"\d+")), F.lit("1"))
    for k, word in reversed(list(enumerate(ORDINALS, 1))):
        out = F.when(upper.contains(word), str(k)).otherwise(out)
    return out


def _contents_end(text: Column) -> Column:
    """Where a list of contents ends; 0 without one."""

    def of(first: Column) -> Column:
        end = first["at"] + F.length(first["whole"])

        def body(rest: Column) -> Column:
            begins = F.regexp_substr(rest, F.lit(BODY))
            return F.when(begins.isNotNull(), end + F.instr(rest, begins) - 1).otherwise(F.least(end + CONTENTS_LENGTH, F.floor(F.length(text) / 5).cast("int")))

        return _let(F.substr(text, end + 1), body)

    return F.when(matches(text, CONTENTS, F.upper(text)), _let(F.get(places(text, CONTENTS), F.lit(0)), of)).otherwise(0)


def boundaries(acts: DataFrame, id: str = "act_id", text: str = "text") -> DataFrame:
    """Provisions of whole acts in order: type, number, title, priority, chapter, chapter_title, part, part_title, is_repealed, [char_start, char_end) and ``body``.

    They follow each other without a gap from the first on.  Lines of footnotes
    and of a list of contents are no sections; Roman numbers are sections of acts that have
    no others; a first preamble counts alone; of boundaries in one place the one of the
    highest priority stays.  An act without any is one ``body``; null texts have no rows.
    """
    acts = acts.select(F.col(id).alias("_id"), F.col(text).alias("_text")).filter("_text is not null")
    listed = acts.select("_id", _contents_end(F.col("_text")).alias("listed"))
    found = match_table(acts, "_id", "_text", PATTERNS, after=1000).join(listed, "_id")
    line = F.regexp_substr(F.concat("whole", "after"), F.lit(r"(?s)^[^\n]*"))
    everything = W.partitionBy("_id")
    # notes can quote what follows a number on the next line; a section's own line decides
    found = found.filter(~((F.col("kind") == "section") & ((F.col("at") < F.col("listed")) | line.rlike(FOOTNOTE_LINE))))
    found = found.filter((F.col("kind") != "roman") | naming.is_roman(F.col("g1")))
    order = {kind: k for k, kind in enumerate(PATTERNS)}
    rank = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    preamble = F.row_number().over(W.partitionBy("_id", "kind").orderBy("at"))
    title = F.when(F.col("kind").isin("section", "roman", "article"), section_title(F.col("after"))).when(F.col("kind") == "preamble", "Preamble").otherwise(heading_title(F.col("after")))
    titled = found.withColumn("title", title)
    kind = F.when(F.col("kind") == "section", section_type(F.col("g1"), F.col("title"))).when(F.col("kind") == "roman", "section").otherwise(F.col("kind"))
    # sections that amend other acts don't make an act one with common numbers
    common = (F.col("kind") == "section") & (kind != "amendment_provision")
    titled = titled.withColumns({"n": preamble, "common": F.max(common.cast("int")).over(everything)})
    titled = titled.filter("not (kind = 'preamble' and n > 1) and not (kind = 'roman' and common = 1)")
    schedule = F.col("kind") == "schedule"
    titled = titled.select(
        "_id", F.col("at").alias("char_start"), kind.alias("type"), F.when(schedule, _schedule_number(F.col("whole"))).otherwise(F.coalesce("g1", F.lit(""))).alias("number"),
        F.when(schedule & (F.col("title") == ""), strip(F.col("whole"))).otherwise(F.col("title")).alias("title"), rank[F.col("kind")].alias("rank"),
    )
    priority = F.create_map(*(F.lit(x) for pair in PRIORITIES.items() for x in pair))
    titled = titled.withColumn("priority", priority[F.col("type")])
    best = W.partitionBy("_id", "char_start").orderBy(F.desc("priority"), "rank")
    titled = titled.withColumn("best", F.row_number().over(best)).filter("best = 1").drop("best", "rank")

    in_order = W.partitionBy("_id").orderBy("char_start")
    carried = in_order.rowsBetween(W.unboundedPreceding, 0)
    context = {}
    for name in ("chapter", "part"):
        latest = F.last(F.when(F.col("type") == f"{name}_heading", F.struct("number", "title")), ignorenulls=True).over(carried)
        context |= {name: F.coalesce(latest["number"], F.lit("")), f"{name}_title": F.coalesce(latest["title"], F.lit(""))}
    ended = titled.withColumns(context | {"char_end": F.lead("char_start").over(in_order)})
    fields = ["char_start", "char_end", "type", "number", "title", "priority", "chapter", "chapter_title", "part", "part_title"]
    # texts meet their boundaries once an act, not once a boundary
    per_act = ended.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("found"))
    whole = F.struct(F.lit(0).alias("char_start"), F.lit(None).cast("int").alias("char_end"), F.lit("body").alias("type"), *(F.lit("").alias(f) for f in ("number", "title")), F.lit(PRIORITIES["body"]).alias("priority"), *(F.lit("").alias(f) for f in fields[6:]))
    rows = acts.join(per_act, "_id", "left").select("_id", "_text", F.explode(F.coalesce("found", F.array(whole))).alias("b"))
    end = F.coalesce("b.char_end", F.length("_text"))
    rows = rows.select("_id", "b.*", F.substr("_text", F.col("b.char_start") + 1, end - F.col("b.char_start")).alias("body"), end.alias("end")).withColumn("char_end", F.col("end"))
    stripped = strip(F.col("body"))
    return rows.select(F.col("_id").alias(id), *fields, ((F.length(stripped) < REPEALED_BELOW) & stripped.rlike(REPEALED)).alias("is_repealed"), "body")


def merged(found: DataFrame, id: str = "act_id", smallest: int = SMALLEST) -> DataFrame:
    """Boundaries with headings put before what follows them, and provisions of fewer than ``smallest`` characters put behind the one before.

    Headings at an act's end go behind the last provision; those that follow each other
    all go forward, so no text is lost.  What is merged has the type, number and title of its
    first provision, the highest priority, and is repealed if all of it is.
    """
    heading = F.col("type").isin(HEADINGS)
    in_order = W.partitionBy(id).orderBy("char_start")
    so_far, rest, everything = in_order.rowsBetween(W.unboundedPreceding, 0), in_order.rowsBetween(0, W.unboundedFollowing), in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = found.withColumns({"_heading": heading, "_place": F.count_if(~heading).over(so_far), "_only": F.count_if(~heading).over(everything) == 0})
    opens = ~F.col("_heading") & ((F.col("_place") == 1) | (F.col("char_end") - F.col("char_start") >= smallest))
    rows = rows.withColumn("_opens", opens).withColumn("_own", F.when(~F.col("_heading"), F.count_if("_opens").over(so_far)))
    # a heading is of the group of what follows it, or of the last one
    rows = rows.withColumn("_group", F.coalesce(F.first("_own", ignorenulls=True).over(rest), F.max("_own").over(everything), F.lit(0)))
    own = F.col("_opens") | (F.col("_only") & F.col("char_end").eqNullSafe(F.max("char_end").over(everything)))
    # the heading right before a group's first provision lends it its title
    lent = F.when(F.col("_opens"), F.lag(F.when(F.col("_heading"), F.col("title"))).over(in_order))
    rows = rows.withColumns({"_first": own, "_lent": lent})
    kept = ["type", "number", "title", "chapter", "part"]
    provision = ~F.col("_heading") | F.col("_only")
    groups = rows.groupBy(id, "_group").agg(
        F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"), F.max(F.when(F.col("_first"), F.struct(*kept, "chapter_title", "part_title", "_lent"))).alias("f"),
        F.max(F.when(provision, F.col("priority"))).alias("priority"), F.bool_and(F.when(provision, F.col("is_repealed"))).alias("is_repealed"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("char_start", "body"))), lambda x: x["body"]), "").alias("body"),
    )
    titles = {c: F.coalesce(F.nullif(F.col(f"f.{c}"), F.lit("")), F.col("f._lent"), F.lit("")) for c in ("chapter_title", "part_title")}
    out = {c: F.col(f"f.{c}") for c in kept} | titles
    return groups.withColumns(out).select(id, *(c for c in found.columns if c != id))


def _paragraphs(text: Column, most: int) -> Column:
    """Paragraphs filled up to ``most`` characters: structs (at, text)."""
    pieces = F.split(text, "\n\n", -1)
    kind = "array<struct<at:int,text:string>>"
    start = F.struct(F.lit(0).alias("next"), F.array().cast(kind).alias("done"), F.lit(0).alias("at"), F.lit("").alias("held"))

    def step(s: Column, p: Column) -> Column:
        blank, none = strip(p) == "", s["held"] == ""
        full = ~none & (F.length(s["held"]) + F.length(p) + 2 > most)
        done = F.when(~blank & full, F.array_append(s["done"], F.struct(s["at"].alias("at"), s["held"].alias("text")))).otherwise(s["done"])
        at = F.when(~blank & (none | full), s["next"]).otherwise(s["at"])
        held = F.when(blank, s["held"]).when(none | full, p).otherwise(F.concat(s["held"], F.lit("\n\n"), p))
        return F.struct((s["next"] + F.length(p) + 2).alias("next"), done.alias("done"), at.alias("at"), held.alias("held"))

    def finish(s: Column) -> Column:
        last = F.array(F.struct(s["at"].alias("at"), s["held"].alias("text")))
        return F.transform(F.filter(F.concat(s["done"], last), lambda x: strip(x["text"]) != ""), lambda x: F.struct(x["at"].alias("at"), strip(x["text"]).alias("text"), F.lit("").alias("sub"), F.lit("section").alias("kind")))

    return F.aggregate(pieces, start, step, finish)


def _at_marks(text: Column, pattern: str, kind: str, most: int) -> Column:
    """Pieces from mark to mark, the large ones in paragraphs; null with fewer than two marks."""

    def cut(marks: Column) -> Column:
        def piece(at: Column, end: Column, sub: Column, kind: str) -> Column:
            return F.struct(at.alias("at"), strip(F.substr(text, at + 1, end - at)).alias("text"), sub.alias("sub"), F.lit(kind).alias("kind"))

        first = F.array(piece(F.lit(0), F.get(marks, F.lit(0))["at"], F.lit(""), "section"))
        rest = F.transform(marks, lambda m, i: piece(m["at"], F.coalesce(F.get(marks, i + 1)["at"], F.length(text)), F.concat(F.lit("("), m["g1"], F.lit(")")), kind))
        whole = F.filter(F.concat(first, rest), lambda p: p["text"] != "")

        def smaller(p: Column) -> Column:
            parts = F.transform(_paragraphs(p["text"], most), lambda x: F.struct((p["at"] + x["at"]).alias("at"), x["text"].alias("text"), p["sub"].alias("sub"), p["kind"].alias("kind")))
            return F.when(F.length(p["text"]) > most, parts).otherwise(F.array(p))

        return F.when(F.size(marks) >= 2, F.flatten(F.transform(whole, smaller)))

    return _let(places(text, pattern, 1), cut)


def pieces(found: DataFrame, id: str = "act_id", most: int = LARGEST) -> DataFrame:
    """Provisions in pieces of at most ``most`` characters where they can be divided: ``piece``, sub_section, provision_type, char_start, ``text``.

    Definitions are cut at clauses, others at sub-sections, and what has not two of
    these, or is still too long, at paragraphs; one paragraph stays whole.  White space at the
    ends of pieces goes; char_start is where a piece's own mark or paragraph stands.
    """
    body = F.col("body")
    whole = F.array(F.struct(F.lit(0).alias("at"), body.alias("text"), F.lit("").alias("sub"), F.col("type").alias("kind")))
    marks = F.coalesce(F.when(F.col("type") == "definitions", _at_marks(body, CLAUSE, "definition_clause", most)), _at_marks(body, SUB_SECTION, "sub_section", most))

    def or_whole(found: Column) -> Column:
        return F.when(F.size(found) > 0, found).otherwise(F.array(F.struct(F.lit(0).alias("at"), body.alias("text"), F.lit("").alias("sub"), F.lit("section").alias("kind"))))

    split = F.when(F.length(body) <= most, whole).otherwise(F.coalesce(marks, _let(_paragraphs(body, most), or_whole)))
    rest = [c for c in found.columns if c not in ("body", "char_start", "char_end")]
    out = found.select(*rest, "char_start", F.posexplode_outer(split).alias("piece", "p"))  # never empty
    return out.select(*rest, "piece", F.col("p.sub").alias("sub_section"), F.col("p.kind").alias("provision_type"), (F.col("char_start") + F.col("p.at")).alias("char_start"), F.col("p.text").alias("text"))
