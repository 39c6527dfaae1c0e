"""Sources, sinks and incremental ingest on small files."""

import gzip
import hashlib
import io
import json
import tarfile

import pytest
from pyspark.sql import types as T

from docketry import schemas
from docketry.sources import readers, sinks
from docketry.streaming import ingest

SCHEMA = T.StructType([T.StructField("case_id", T.StringType()), T.StructField("n", T.LongType())])


def test_json_lines_keep_bad_lines_apart(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"case_id": "x", "n": 1}\n\nnot json\n')
    with gzip.open(tmp_path / "b.jsonl.gz", "wt") as f:
        f.write('{"case_id": "y", "n": 2}\n')
    good, bad = readers.json_lines(spark, str(tmp_path), SCHEMA)
    assert sorted(r.case_id for r in good.collect()) == ["x", "y"]
    assert [r._bad for r in bad.collect()] == ["not json"]


def test_tar_members(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        for name in ("2020_INSC_7_HIN.chunks.jsonl", "2020_INSC_8.chunks.jsonl", "odd.txt"):
            data = b'{"a": 1}\n{"a": 2}\n'
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    rows = readers.with_base_and_language(readers.tar_lines(spark, str(tmp_path))).collect()
    assert len(rows) == 6
    assert {(r.base_id, r.lang) for r in rows} == {("2020_INSC_7", "HIN"), ("2020_INSC_8", "EN"), (None, None)}


def test_release_is_gated_and_pinned(spark, tmp_path):
    rows = spark.createDataFrame([("c1", "body", "DLHC"), ("c2", "other", "KLHC")], "case_id string, text string, court_code string")
    out = sinks.release(rows, str(tmp_path / "r"), schemas.CASE_LAW, "court_code")
    assert [tuple(r) for r in out.collect()] == [("DLHC", 1), ("KLHC", 1)]
    assert spark.read.parquet(str(tmp_path / "r")).drop("_court_code").columns == schemas.CASE_LAW
    sums = sinks.checksums(spark, str(tmp_path / "r")).collect()
    for r in sums:
        assert hashlib.sha256(open(r.path.removeprefix("file:"), "rb").read()).hexdigest() == r.sha256
    with pytest.raises(sinks.GateError, match="c3: empty text"):
        sinks.release(spark.createDataFrame([("c3", " ", "X")], "case_id string, text string, court_code string"), str(tmp_path / "s"), schemas.CASE_LAW, "court_code")
    assert not (tmp_path / "s").exists()
    with pytest.raises(ValueError, match="r2_key"):
        schemas.gate(rows.withColumnRenamed("court_code", "r2_key"))


def test_shards_and_replaced_groups(spark, tmp_path):
    rows = spark.createDataFrame([("a", "", 1), ("b", "x", 2)], "k string, t string, n int")
    sinks.json_shards(rows, str(tmp_path / "j"), "k")
    lines = [json.loads(x) for p in (tmp_path / "j").rglob("*.gz") for x in gzip.open(p, "rt")]
    assert sorted(map(str, lines)) == sorted(map(str, [{"n": 1}, {"t": "x", "n": 2}]))
    sinks.replace_groups(rows, str(tmp_path / "g"), "k")
    sinks.replace_groups(rows.filter("k = 'a'").withColumn("n", rows.n + 10), str(tmp_path / "g"), "k")
    assert sorted((r.k, r.n) for r in spark.read.parquet(str(tmp_path / "g")).collect()) == [("a", 11), ("b", 2)]


def test_field_maps_and_filters(spark):
    raw = spark.createDataFrame([("A", "", "1", "z")], "assessee string, name string, no string, other string")
    r = readers.field_map(raw, {"petitioner": ["name", "assessee"], "case_number": ["no"], "bench": ["absent"]}).first()
    assert (r.petitioner, r.case_number, r.bench, json.loads(r.raw_metadata)) == ("A", "1", None, {"other": "z"})
    f = raw.select(readers.judgment_filter("contains", raw.other, "q, Z").alias("a"), readers.judgment_filter("not_empty", raw.name).alias("b"), readers.judgment_filter("equals", raw.assessee, "a").alias("c")).first()
    assert tuple(f) == (True, False, True)


def test_ingest_takes_each_file_once(spark, tmp_path):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"case_id": "x", "n": 1}\n')
    for extra in ("b", "c"):
        ingest.append_new(ingest.new_files(spark, source, SCHEMA), out, check).awaitTermination(60)
        (tmp_path / f"in/{extra}.json").write_text(f'{{"case_id": "{extra}", "n": 2}}\n')
    assert sorted(r.case_id for r in spark.read.parquet(out).collect()) == ["b", "x"]
