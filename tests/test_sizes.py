"""What grows with the tables: work is in as many parts as cores need, and pairs that can't match don't meet."""

import random

from pyspark.sql import functions as F

from docketry.plans.queries import spread


def test_rows_of_one_file_are_in_parts_for_all_cores(spark):
    one = spark.range(1000).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism == spread(one, "id").rdd.getNumPartitions()
    assert spread(one).agg(F.sum("id")).first()[0] == 499500


def test_people_are_found_once_and_by_the_first_pattern(spark):
    """A text is searched once for what parts its parties, and lines behind the first name aren't looked at."""
    from docketry.functions import people

    texts = ["Ram Das Versus State of Kerala", "x ..... Petitioner Vs. Hari Lal ... Respondent", "A Kumar -vs- B Sharma", "", None, "CORAM : x\nJUSTICE A B SEN\n", "1. Ram Das ...Petitioner\nVersus\n12\n***\nHari Lal ...Respondent"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", people.parties(F.col("t"), F.col("t")).alias("p"), people.judges(F.col("t")).alias("j"))
    got = {r.k: (r.p.petitioner, r.p.respondent, r.j) for r in rows.collect()}
    assert got[0][:2] == ("Ram Das", "State of Kerala") and got[2][:2] == ("A Kumar", "B Sharma") and got[6][:2] == ("Ram Das", "Hari Lal")
    assert got[3] == got[4] == (None, None, []) and got[5][2] == ["A B SEN"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(people.VERSUS) == 1


def test_similar_names_are_found_without_comparing_all(spark):
    """Against every pair compared; names of the same id count as one, and trigrams that all names hold join nothing."""
    from docketry.operators import retrieval

    draw = random.Random(7)
    names = [(k, f"Supplier#{draw.randrange(10**4):06}") for k in range(300)] + [(300, None), (301, ""), (302, "#"), (5, "other words"), (303, "a")]
    table = spark.createDataFrame(names, "id long, name string")
    asked = table.filter("id % 3 = 0").select(F.col("id").alias("q"), F.col("name").alias("query"))
    grams: dict[int, set[str]] = {}
    for r in table.select("id", retrieval.trigrams(F.col("name")).alias("t")).collect():
        grams.setdefault(r.id, set()).update(r.t or [])
    for least in (0.3, 0.8, 1.0):
        found = retrieval.trigram_search(table, asked, "id", "name", "q", "query", least)
        want = {(a, b): len(x & y) / len(x | y) for a, x in grams.items() if a % 3 == 0 for b, y in grams.items() if x & y and len(x & y) / len(x | y) >= least}
        got = found.collect()
        assert len(got) == len(want) and {(r.q, r.id): r.similarity for r in got} == want


def test_acts_of_one_file_are_searched_by_all_cores(spark):
    from docketry.plans import act_queries

    assert act_queries._acts(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_places_are_the_same_whether_or_not_a_text_holds_the_mark(spark):
    """One search marks the matches; a text that holds the mark itself is searched as before."""
    from docketry.operators import matches

    texts = ["a1 b22\né\U0001f600c3", "none", "", None, "7", f"a1{matches.MARK}b22", "x$1 \\2"]
    pattern = r"([a-z])?(\d+)"
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", matches.places(F.col("t"), pattern, 2).alias("p"))
    got = {r.k: [tuple(m) for m in r.p] for r in rows.collect()}
    assert got == {0: [(0, "a1", "a", "1"), (3, "b22", "b", "22"), (9, "c3", "c", "3")], 1: [], 2: [], 3: [], 4: [(0, "7", "", "7")], 5: [(0, "a1", "a", "1"), (3, "b22", "b", "22")], 6: [(2, "1", "", "1"), (5, "2", "", "2")]}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count(f"(({pattern})") <= 1


def test_scores_are_summed_where_a_document_is(spark):
    """No shuffle of a score for each query and document; rows of the same id and length count as one document."""
    import re

    from docketry.operators import retrieval

    docs = spark.createDataFrame([(1, "tax law tax"), (2, "tax court"), (3, None), (4, "law of law"), (4, "tax law act")], "d long, text string")
    queries = spark.createDataFrame([(1, "tax law"), (2, "court unknown"), (3, None)], "query_id long, query string")
    found = retrieval.bm25(retrieval.postings(docs, "d", "text"), 5, queries, 2, "d")
    assert {(r.query_id, r.d) for r in found.collect()} == {(1, 1), (1, 4), (2, 2)}
    plan = found._jdf.queryExecution().sparkPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(query_id#\w+, d#|hashpartitioning\(token#\w+, d#", plan)
