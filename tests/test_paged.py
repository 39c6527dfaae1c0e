"""Tables read by key, archives as partitions, and section files."""

import io
import json
import sqlite3
import tarfile

import pytest

from docketry.sources import paged


def test_keyset_pages_cover_a_table_once(spark, tmp_path):
    path = str(tmp_path / "t.db")
    con = sqlite3.connect(path)
    con.execute("create table t (id integer primary key, name text)")
    con.executemany("insert into t values (?, ?)", [(k * 3, f"n{k}" if k % 5 else None) for k in range(250)])
    con.commit()
    con.close()

    def fetch(after, to, limit):
        with sqlite3.connect(path) as c:
            c.row_factory = sqlite3.Row
            found = c.execute("select id, name from t where (? is null or id > ?) and (? is null or id <= ?) order by id limit ?", (after, after, to, to, limit))
            return [dict(r) for r in found]

    rows = paged.keyset(spark, fetch, "id", "id long, name string", [100, 101, 600], page=20)
    assert rows.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, rows.collect())) == [(k * 3, f"n{k}" if k % 5 else None) for k in range(250)]
    assert rows.filter("id > 10000").count() == 0
    with pytest.raises(Exception, match="don't rise"):
        paged.keyset(spark, lambda after, to, limit: [{"id": 2}, {"id": 1}], "id", "id long", [], page=2).collect()


@pytest.mark.parametrize("mode", ["w", "w:gz"])
def test_archives_are_read_a_task_each(spark, tmp_path, mode):
    paths = []
    for a in range(2):
        paths.append(str(tmp_path / f"a{a}.tar"))
        with tarfile.open(paths[-1], mode) as archive:
            for name, content in ((f"m{a}.jsonl", b'{"x": 1}\n\nlast \xff'), ("empty", b"")):
                info = tarfile.TarInfo(name)
                info.size = len(content)
                archive.addfile(info, io.BytesIO(content))
            archive.addfile(tarfile.TarInfo("folder"), None)
    rows = paged.archives(spark, paths)
    assert rows.rdd.getNumPartitions() == 2
    assert sorted((r.archive, r.member, r.line_no, r.line) for r in rows.collect()) == [(p, f"m{a}.jsonl", n, line) for a, p in enumerate(paths) for n, line in enumerate(['{"x": 1}', "", "last �"])]


def test_sections_of_acts(spark, tmp_path):
    section = {"sectionNo": "1", "label": "Short title", "content": "<p>x</p>", "footnote": None, "sectionId": "9"}
    (tmp_path / "a.json").write_text(json.dumps({"handle": "h/1", "sectionCount": 2, "sections": [section, section | {"sectionNo": "2"}]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"handle": "h/2", "sectionCount": 3, "sections": [section]}))
    (tmp_path / "c.json").write_text("not json")
    (tmp_path / "d.json").write_text(json.dumps({"handle": "h/3", "sectionCount": 0, "sections": []}))
    rows = paged.act_sections(spark, str(tmp_path)).orderBy("handle", "order").collect()
    assert [(r.handle, r.order, r.section_no, r.label, r.complete) for r in rows] == [("h/1", 0, "1", "Short title", True), ("h/1", 1, "2", "Short title", True), ("h/2", 0, "1", "Short title", False)]


def test_texts_of_sections_in_html(spark):
    rows = [
        ("h", 1, "2", "Powers ", "<p>One&amp;two<br/>three<sup>1</sup> </p><hr><span style=\"margin-left:20px;\"> </span><span style=\"margin-left:5px;\">kept</span>", "1. Subs. by <i>Act</i> 5 <br>2. x &lt; y  \r\n"),
        ("h", 0, "1", None, "", None),
        ("h", 2, None, "", None, ""),
        ("h", 3, "", "Label", None, "<p> </p>"),
    ]
    sections = spark.createDataFrame(rows, "handle string, order int, section_no string, label string, content string, footnote string")
    (act,) = paged.act_texts(sections).collect()
    assert (act.sections, act.text) == (3, "1.\n\n2. Powers\nOne&two\nthree[1]\n\nkept\n\n[Footnotes]\n1. Subs. by Act 5\n2. x < y\n\nLabel")
