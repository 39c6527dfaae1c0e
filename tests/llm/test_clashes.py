"""Columns of the input with the operators' own names, and model files that are lost."""

import pytest

NAMES = ["_hash", "_id", "_h", "_gone", "_key", "_long_ids", "whole", "cut", "_whole", "_cut", "_domain", "_lang", "_source", "k1", "no", "hash", "rest", "c"]


def clashing(spark):
    rows = [(k, f"some words of line {k % 3}\nand one more line that comes back\n" * 2, "en", f"src{k % 4}") for k in range(12)] + [(20, None, None, None), (21, "x" * 3000, "en", "src1")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", *(f"doc_id * 7 AS {n}" for n in NAMES))


def check(got, n=None):
    assert n is None or len(got) == n
    assert all(r[c] == r.doc_id * 7 for r in got for c in NAMES)


def test_columns_of_the_same_names_pass_through(spark):
    from docketry.llm import bpe, lines, mixing

    docs = clashing(spark)
    check(lines.dedup_lines(docs).collect(), 14)
    mixed = mixing.mix(docs, fraction=0.7)
    assert mixed.columns == [*docs.columns, "domain", "epochs"]
    check(mixed.collect())
    check(bpe.encode(docs, pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"), long=1000).collect(), 14)


def test_a_lost_model_file_is_an_error(spark, tmp_path):
    import numpy as np

    from docketry.llm import hasharrays as ha

    folder, keys = f"file://{tmp_path}", np.array([3, 9], np.uint64)
    ha.put(folder, "w000000", {"keys": keys, "counts": keys})
    assert ha.lookup(folder, "w", np.zeros(2, np.int64), keys, ("counts",))[1].tolist() == [3, 9]
    with pytest.raises(FileNotFoundError):
        ha.lookup(folder, "w", np.array([0, 1]), keys, ("counts",))
