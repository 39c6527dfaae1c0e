"""Acts behind a list of contents, ids of cases as their JSON gives them, and incoming rows of the same key."""

import hashlib
import json

from pyspark.sql import functions as F


def found(spark, text):
    from docketry.operators import chunking

    rows = chunking.provisions(spark.createDataFrame([("x", text)], "act_id string, text string")).collect()
    return [(r.type, r.number) for r in sorted(rows, key=lambda r: r.char_start)]


LIST = "ARRANGEMENT OF SECTIONS\n1. Short title\n2. Definitions\n"
SECTIONS = "1. Short title.—This Act may be called.\n2. Definitions.—In this Act\n"


def test_sections_after_a_list_of_contents_stay(spark):
    for mark in ("ACT NO. 5 OF 1950", "Be it enacted by Parliament", "PREAMBLE"):
        assert found(spark, f"{LIST}{mark}\n{SECTIONS}") == [("section", "1"), ("section", "2")]
    assert found(spark, f"{LIST}An Act to test\n{SECTIONS}") == [("preamble", "An Act to"), ("section", "1"), ("section", "2")]
    # without any mark the list is a fifth of the text at most
    assert ("section", "9") in found(spark, LIST + SECTIONS * 10 + "9. Last.—x\n")
    assert found(spark, SECTIONS) == [("section", "1"), ("section", "2")]


def test_footnotes_and_later_preambles_do_not_count(spark):
    notes = '> 2. The words "and" omitted\n> 3. Cl. (b) Renumbered\n4. See Act 5\n> 5. This Act came\n6. S. 3\n'
    assert found(spark, f"An Act to test\n1. Short title\n{notes}An Act to amend\n") == [("preamble", "An Act to"), ("section", "1")]


def test_case_ids_hash_the_json_with_sorted_keys(spark):
    from docketry.functions import extract

    rows = [("ITA 5/2010", "Delhi", 2010), (None, 'a"b\\é中😀\n', 2011), ("", None, None)]
    got = spark.createDataFrame(rows, "number string, bench string, year int").select(
        extract.case_id("itat", F.col("number"), {"year": F.col("year").cast("string"), "bench": F.col("bench")}).alias("a"),
        extract.case_id("itat", F.col("number"), {"year": F.col("year").cast("string"), "bench": F.col("bench")}, with_context=True).alias("b"),
    )
    digest = [hashlib.md5(json.dumps({"bench": b, "year": None if y is None else str(y)}, sort_keys=True).encode()).hexdigest() for _, b, y in rows]
    assert [tuple(r) for r in got.collect()] == [("ITAT_ITA52010", f"ITAT_ITA52010_{digest[0][:8]}"), (f"ITAT_{digest[1][:12]}",) * 2, (f"ITAT_{digest[2][:12]}",) * 2]


def test_of_incoming_rows_with_the_same_key_one_lands(spark):
    from docketry.operators import joins

    current = spark.createDataFrame([(1, "old", 0), (2, "old", 0)], "k int, v string, at int")
    incoming = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (3, "c", 5), (3, "d", 4), (3, None, 6)], "k int, v string, at int")
    merged = joins.upsert(current, incoming, ["k"], order=["at"]).collect()
    assert sorted(map(tuple, merged)) == [(1, "b", 2), (2, "old", 0), (3, None, 6)]
    kept = joins.upsert(current, incoming, ["k"], merge=False, order=["at"]).collect()
    assert sorted(map(tuple, kept)) == [(1, "old", 0), (2, "old", 0), (3, "d", 4)]
