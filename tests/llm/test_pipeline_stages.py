"""Each stage of the pipeline on odd documents: nulls, empty and long texts, repeated rows, no rows; and stages 1 and 4 on what they must do."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLEAN = "the committee met on {} and agreed to publish the yearly report on bridges and roads number {}"
TOXIC = "you filthy scum number {} i hate you worthless vermin {} drop dead idiot"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows], SCHEMA)


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """A folder with labels of 400 documents, half of them toxic, and these documents."""
    folder = tmp_path_factory.mktemp("sf")
    rows = [(k, (TOXIC if k % 2 else CLEAN).format(k, k * 7), "en", f"src{k % 5}") for k in range(400)]
    spark.createDataFrame([(k, 1, k % 2) for k in range(400)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder), rows


ODD = [(1001, None, "en", "src1"), (1002, "", None, None), (1003, " \n\n ", "de", "x"), (1004, "one line\n" + "long text of many words " * 20_000, "en", "src2"), (1005, "same", "en", "src1"), (1005, "same", "en", "src1"), (None, "no id here", "en", "src1")]


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_odd_documents_and_none_at_all(spark, labelled, name):
    folder, rows = labelled
    docs = documents(spark, ODD + rows[:60])
    got = STAGES[name](spark, docs, folder)
    if name != "bpe":
        assert got.schema.names == docs.schema.names
    found = got.collect()
    assert len({r.doc_id for r in found} - {r.doc_id for r in docs.collect()}) == 0 and len(found) <= docs.count()
    assert STAGES[name](spark, documents(spark, []), folder).count() == 0


def test_toxicity_stage_drops_what_is_toxic_alone(spark, labelled):
    folder, rows = labelled
    kept = {r.doc_id: r.text for r in STAGES["toxicity"](spark, documents(spark, rows + ODD[:3]), folder).collect()}
    texts = dict((k, t) for k, t, _, _ in rows)
    assert {k for k in texts if k % 2 == 0} <= set(kept) and not {k for k in kept if k < 400 and k % 2}
    assert all(kept[k] == texts[k] for k in kept if k < 400)


def test_mixing_stage_keeps_whole_rows_once_within_its_share(spark, labelled):
    folder, rows = labelled
    docs = documents(spark, rows)
    kept = STAGES["mixing"](spark, docs, folder).collect()
    by_id = {r.doc_id: r for r in docs.collect()}
    assert len({r.doc_id for r in kept}) == len(kept) and all(tuple(r) == tuple(by_id[r.doc_id]) for r in kept)
    words = {k: len(r.text.split()) for k, r in by_id.items()}
    spent, whole = sum(words[r.doc_id] for r in kept), sum(words.values())
    assert 0.8 * whole * 0.5 < spent <= 0.8 * whole


def test_bpe_stage_returns_rows_of_ids(spark, labelled):
    folder, _ = labelled
    rows = STAGES["bpe"](spark, documents(spark, ODD), folder).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.n_tokens * 4 == len(r.ids) and len(r.ids_sha256) == len(r.decoded_sha256) == 64
    assert {r.n_tokens for r in rows if r.doc_id in (1001, 1002, 1003)} == {0}
