"""The citation graph: aliases from texts, growth by batches, stubs resolved by a stored index."""

from pyspark.sql import functions as F

from docketry.operators import graph, retrieval


def test_aliases_that_cases_give_themselves(spark):
    rows = [
        ("a", 1, "later: reported as AIR 2001 SC 9", 2001),
        ("a", 0, "this case, reported in (1999) 2 SCC 10, was REPORTED in (2001) 11 SCC 706", 2001),  # 1999 is too far off
        ("b", 0, "cited as (2010) 1 SCC 5 and reported as AIR 2010 SC 7", 2011),
        ("c", 0, "reported in (1980) 1 SCC 5", 2000),
        ("d", 0, "reported in (1980) 1 SCC 5", None),
        ("e", 0, None, 2000),
        ("f", 0, "nothing", 2000),
    ]
    chunks = spark.createDataFrame(rows, "case_id string, chunk_index int, text string, year int")
    got = {r.case_id: (r.alias, r.normalized, r.citation_type) for r in graph.mined_aliases(chunks).collect()}
    assert got == {"a": ("(2001) 11 SCC 706", "2001 11 SCC 706", "SCC"), "b": ("AIR 2010 SC 7", "AIR 2010 SC 7", "AIR"), "d": ("(1980) 1 SCC 5", "1980 1 SCC 5", "SCC")}
    cases = spark.createDataFrame([("L1", "a"), ("L2", "b"), ("L3", "z")], "legal_case_id string, corpus_case_id string")
    assert {(r.legal_case_id, r.alias) for r in graph.known_aliases(graph.mined_aliases(chunks), cases).collect()} == {("L1", "(2001) 11 SCC 706"), ("L2", "AIR 2010 SC 7")}


def test_keys_years_courts_and_names(spark):
    cases = [(" ( 2019 )  11 s.c.c . 706", "mumbai ", 1859), ("ＡＩＲ 2001\xa0SC 1", "SC", 1860), (None, None, None)]
    row = spark.createDataFrame(cases, "c string, code string, y int").select(graph.stub_key(F.col("c")).alias("k"), graph.court_code(F.col("code")).alias("code"), graph.valid_year(F.col("y")).alias("ok"), graph.scc_year(F.col("c")).alias("y")).collect()
    assert [tuple(r) for r in row] == [("(2019) 11 S.C.C.706", "BOM", False, None), ("AIR 2001 SC 1", "SC", True, None), (None, None, False, None)]
    text = spark.createDataFrame([("State of Kerala v. Raman Nair (2001), In Re: A Ltd vs. B Ltd 1999",)], "t string").select(graph.case_names(F.col("t")).alias("n")).first()
    assert [(n.first, n.second) for n in text.n] == [("State of Kerala", "Raman Nair"), ("A Ltd", "B Ltd")]


def test_a_graph_grows_batch_by_batch(spark, tmp_path):
    path = str(tmp_path / "graph")
    nodes = spark.createDataFrame([("n1", "AIR 2001 SC 1"), ("n2", "2002 INSC 2")], "id string, key string")
    first = spark.createDataFrame([("n1", "air 2001 SC 1"), ("n1", "2002 INSC 2"), ("n1", "2002  INSC 2"), ("n2", "(2003) 1 S.C.C. 3"), ("n2", "(2003) 1 SCC 3"), ("n2", "")], "citing string, raw string")
    assert graph.grow(spark, path, "b1", first, nodes) == 2  # itself, and twice the same, go
    stubs = spark.read.parquet(f"{path}/nodes").collect()
    assert [(r.key, r.raw) for r in stubs] == [("(2003) 1 SCC 3", "(2003) 1 S.C.C. 3")]
    second = spark.createDataFrame([("n1", "2002 INSC 2"), ("n1", "(2003) 1 SCC 3"), ("n1", "AIR 1990 SC 5")], "citing string, raw string")
    assert graph.grow(spark, path, "b2", second, nodes) == 2
    assert graph.grow(spark, path, "b2", first, nodes) == 2  # it has its mark
    edges = {(r.citing, r.cited) for r in spark.read.parquet(f"{path}/edges").collect()}
    assert len(edges) == 4 and ("n1", "n2") in edges and ("n1", stubs[0].id) in edges
    (tmp_path / "graph" / "marks" / "b2").rmdir()  # as if the run had died before its mark
    assert graph.grow(spark, path, "b2", second, nodes) == 2
    assert {(r.citing, r.cited) for r in spark.read.parquet(f"{path}/edges").collect()} == edges


def test_stored_index_ranks_as_one_made_anew_and_resolves_stubs(spark, tmp_path):
    docs = spark.createDataFrame([("c1", "decided as (2019) 11 SCC 706 by the court", 2019), ("c2", "mentions 2019 and 706 SCC SCC", 2001), ("c3", "other words", 2019), ("c4", "see (2019) 11 SCC 706 again (2019) 11 SCC 706", 2000), ("c5", None, 2019)], "case_id string, text string, year int")
    index = retrieval.Index.build(docs, str(tmp_path / "index"), "case_id", "text", buckets=4)
    queries = spark.createDataFrame([(1, "(2019) 11 SCC 706"), (2, "other court"), (3, "absent"), (4, None)], "query_id int, query string")
    anew = retrieval.bm25(retrieval.postings(docs, "case_id", "text"), docs.count(), queries, 3, "case_id")
    rows = lambda f: sorted((r.query_id, r["rank"], r.case_id, round(r.score, 9)) for r in f.collect())
    assert rows(index.search(queries, 3)) == rows(anew) and rows(anew)
    stubs = spark.createDataFrame([("(2019) 11 SCC 706",), ("(1950) 1 SCC 1",), ("(2019) 9 SCC 9",)], "citation string")
    aliases = spark.createDataFrame([("(2019) 9 SCC 9",)], "normalized string")
    got = graph.resolved_stubs(stubs, index, docs.select("case_id", "year"), aliases).collect()
    assert [(r.citation, r.case_id) for r in got] == [("(2019) 11 SCC 706", "c1")]  # c4 ranks first, but is of another year
