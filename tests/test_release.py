"""The release bars whole cases, and inventories of tables without rows or values."""

import pytest


def test_one_chunk_bars_its_whole_case(spark):
    from docketry.operators import release

    rows = [
        ("a", 0, "plain text, call 9447091300"),
        ("a", 1, None),
        ("b", 0, "plain text"),
        ("b", 1, "it shall not be published"),
        ("c", 0, "Cite this article"),
        ("d", 0, "the matter was heard in"),
        ("d", 1, "camera as directed"),  # a direction may run over two chunks
        ("e", 0, None),
    ]
    chunks = spark.createDataFrame(rows, "case_id string, chunk_index long, text string")
    status = release.case_status(chunks)
    assert {r.case_id: r.status for r in status.collect()} == {"a": "kept", "b": "excluded_non_publication", "c": "purged_third_party_source", "d": "excluded_non_publication", "e": "kept"}
    kept = release.redacted_chunks(chunks, status)
    out = {(r.case_id, r.chunk_index): r for r in release.published(kept).collect()}
    assert set(out) == {("a", 0), ("a", 1), ("e", 0)}
    assert out["a", 0].text == "plain text, call [REDACTED]" and out["a", 0].language_code == "en" and out["a", 1].text is None
    assert {r.name: r.n for r in release.release_counts(status, kept).collect()} == {
        "documents_kept": 2, "documents_excluded_non_publication": 2, "documents_purged_third_party_source": 1, "chunks_kept": 3, "redacted_phone": 1,
    }
    assert release.case_status(chunks.limit(0)).count() == 0


def test_original_texts_are_judged_first_and_masked_too(spark):
    from docketry.operators import release

    rows = [
        ("a", 0, "call 9447091300", "original call 9447091301 or 9447091302"),
        ("b", 0, "plain", "it was heard in camera"),
        ("c", 0, "heard in camera", "plain"),  # its text isn't looked at, as it has an original
        ("d", 0, "heard in camera", ""),
        ("e", 0, None, None),
    ]
    chunks = spark.createDataFrame(rows, "case_id string, chunk_index long, text string, text_original string")
    status = release.case_status(chunks)
    assert {r.case_id: r.status for r in status.collect()} == {"a": "kept", "b": "excluded_non_publication", "c": "kept", "d": "excluded_non_publication", "e": "kept"}
    out = {r.case_id: r for r in release.redacted_chunks(chunks, status).collect()}
    assert (out["a"].text, out["a"].text_original, out["a"].counts) == ("call [REDACTED]", "original call [REDACTED] or [REDACTED]", {"phone": 3})
    assert out["c"].counts == out["e"].counts == {} and out["e"].text is None
    courts = release.case_status(spark.createDataFrame([("KLHC1", 0, "x"), ("ZZZZ1", 0, "Cite this article")], "case_id string, chunk_index long, text string"), known_courts=True)
    assert {r.case_id: r.status for r in courts.collect()} == {"KLHC1": "kept", "ZZZZ1": "unknown_court_code"}


def test_a_release_is_written_whole_or_not_at_all(spark, tmp_path):
    from docketry.operators import release
    from docketry.sources import sinks

    schema = "case_id string, chunk_index long, text string, text_original string, court string"
    good = spark.createDataFrame([("a", 0, "call 9447091300", "write to a.b@example.org", "Kerala"), ("b", 0, "not reported in any media", None, "Kerala"), ("c", 0, "fine", None, "Delhi")], schema)
    made = release.run(good, str(tmp_path / "out"))
    assert {r.court: r.rows for r in made.collect()} == {"Kerala": 1, "Delhi": 1}
    rows = {r.case_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(rows) == {"a", "c"} and rows["a"].text == "call [REDACTED]" and rows["a"].text_original == "write to [REDACTED]"
    total = sinks.totals(spark, str(tmp_path / "out"), "v1").first()
    assert (total.version, total.files, total.rows) == ("v1", 2, 2) and total.bytes > 0
    with pytest.raises(FileExistsError):
        release.run(good, str(tmp_path / "out"))
    bad = good.unionByName(spark.createDataFrame([("d", 0, " ", None, "Delhi")], schema))
    with pytest.raises(sinks.GateError, match="d: empty text"):
        sinks.release(bad, str(tmp_path / "bad"), list(release.schemas.CASE_LAW), "court", str(tmp_path / "refused"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out", "refused"]
    assert [r.case_id for r in spark.read.parquet(str(tmp_path / "refused")).collect()] == ["d"]


def test_invalid_outputs_are_set_aside_and_done_again(spark, tmp_path):
    from docketry.sources import sinks

    chunks = spark.createDataFrame([("a", "x" * 100, 1), ("b", "x" * 100, 1), ("b", "short", 2), ("c", "x" * 100, None)], "doc string, text string, page int")
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "doc string")
    valid, again = sinks.validated(chunks, wanted, "doc", ["page"], str(tmp_path / "q"))
    assert [r.doc for r in valid.collect()] == ["a"] and sorted(r.doc for r in again.collect()) == ["b", "c", "d"]
    assert sorted(r.doc for r in spark.read.parquet(str(tmp_path / "q")).collect()) == ["b", "b", "c"]


def test_caps_medians_and_queues(spark):
    from docketry.operators import inventory

    chunks = spark.createDataFrame([("a", k, "x" * 10) for k in range(30)] + [("b", 0, " "), ("b", 1, None)], "k string, no int, text string")
    by_count = {r.k: (r.chunks, len(r.text)) for r in inventory.capped_texts(chunks, "k", "no", "text").collect()}
    assert by_count == {"a": (20, 240)}
    assert {r.k: r.chunks for r in inventory.capped_texts(chunks, "k", "no", "text", 20, 24).collect()} == {"a": 3}
    sizes = spark.createDataFrame([("a", 0), ("a", 5), ("a", 7), ("a", 9), ("a", 9), ("b", 0), ("c", None)], "k string, v int")
    assert {r.k: r.median for r in inventory.upper_median(sizes, "k", "v").collect()} == {"a": 9, "b": 0, "c": 0}
    done = spark.createDataFrame([(1, "x"), (1, "x")], "k int, axis string")
    queue = inventory.work_queue(spark.createDataFrame([(1,), (2,)], "k int"), {"axis": ["x", "y"]}, done, ["k", "axis"])
    assert sorted(map(tuple, queue.collect())) == [(1, "y"), (2, "x"), (2, "y")]


@pytest.mark.parametrize("name", ["issuer_totals", "objects_by_folder", "corruption_reports", "court_codes", "released_cases", "roman_numbers", "extracted_citations"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from docketry.plans import QUERIES, SQL

    base = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("customer", "part", "orders", "lineitem", "documents", "conversations"):
        con.execute(f"create view {t} as select * from '{base}/{t}.parquet'")
    frame = QUERIES[name](spark, base)
    want = con.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(map(repr, (tuple(r) for r in frame.select(names).collect()))) == sorted(map(repr, want.fetchall()))
