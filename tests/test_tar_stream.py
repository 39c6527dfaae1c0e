"""Archives are streamed in small batches, not read whole."""

import io
import tarfile

from docketry.sources import readers


def test_lines_come_in_bounded_batches_and_are_dealt_out(spark, tmp_path):
    texts = {"long.jsonl": [f"line {k}" for k in range(20_000)], "wide.jsonl": ["x" * 3_000_000] * 3, "empty.jsonl": []}
    with tarfile.open(tmp_path / "a b.tar.gz", "w:gz") as t:
        for name, lines in texts.items():
            data = "".join(x + "\n" for x in lines).encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    with open(tmp_path / "a b.tar.gz", "rb") as stream:
        assert max(b.num_rows for b in readers._batches("a", stream)) <= readers.BATCH_LINES
    with open(tmp_path / "a b.tar.gz", "rb") as stream:
        assert max(b.nbytes for b in readers._batches("a", stream)) <= readers.BATCH_BYTES + 1000
    found = readers.tar_lines(spark, str(tmp_path))
    assert "content" not in found._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[-1].split("Relation")[0]
    assert found.rdd.getNumPartitions() > 1
    got = {}
    for r in found.orderBy("member", "line_no").collect():
        assert len(got.setdefault(r.member, [])) == r.line_no
        got[r.member].append(r.line)
    assert got == {name: lines for name, lines in texts.items() if lines}
