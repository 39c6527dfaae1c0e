"""Exact copies of lines too short for near duplicates."""


def test_copies_of_short_lines_go(spark):
    from docketry.llm import lines

    rows = [(1, "All rights reserved.\n\n春はあけぼの\na b c d e"), (2, "all  rights reserved.\n\n春はあけぼの\na b c d X\nAll rights"), (3, "All rights\nx"), (4, None), (5, "x\n\nx")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # blank lines stay; "All rights" is one edit from "All rights reserved." and isn't a copy of it
    assert {r.doc_id: r.text for r in got} == {1: rows[0][1], 2: "\n\nAll rights".removeprefix("\n"), 3: "x", 4: None, 5: ""}
    assert {r.doc_id: r.n_dropped for r in got} == {1: 0, 2: 3, 3: 1, 4: 0, 5: 2}
