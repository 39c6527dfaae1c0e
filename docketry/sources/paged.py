"""Sources that Spark has no reader for: tables that are read page by page by key, archives as partitions, and section files of acts."""

from __future__ import annotations

import tarfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.text import section_to_text

#: Rows of a page.
PAGE = 1000

#: A page: the rows with a key above the first and up to the second argument, in the key's order, so many at most.
Fetch = Callable[[Any, Any, int], Sequence[dict]]


class _Range(InputPartition):
    def __init__(self, after: Any, to: Any) -> None:
        self.after, self.to = after, to


def keyset(spark: SparkSession, fetch: Fetch, key: str, schema: str, bounds: Sequence[Any], page: int = PAGE) -> DataFrame:
    """A table behind ``fetch``, read in pages each of which starts after the last one's key.

    ``bounds`` part the keys into ranges, one task each: up to the first bound, between
    them, and beyond the last; so no task, and no offset, grows with the table.  A lost
    task reads its range again.  Keys are unique and not null; a page whose keys don't rise is an error.
    """

    label, names = f"keyset_{uuid.uuid4().hex}", spark.createDataFrame([], schema).columns

    class Reader(DataSourceReader):
        def partitions(self) -> Sequence[InputPartition]:
            edges = [None, *bounds, None]
            return [_Range(a, b) for a, b in zip(edges, edges[1:], strict=False)]

        def read(self, partition: _Range) -> Iterator[tuple]:
            last = partition.after
            while True:
                rows = list(fetch(last, partition.to, page))
                keys = [r[key] for r in rows]
                if any(b <= a for a, b in zip(([] if last is None else [last]) + keys, keys if last is not None else keys[1:], strict=False)):
                    raise ValueError(f"keys of a page after {last!r} don't rise")
                yield from (tuple(r.get(n) for n in names) for r in rows)
                if len(rows) < page:
                    return
                last = keys[-1]

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def schema(self) -> str:
            return schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format(Source.name()).load()


class _Archive(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


def archives(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of the members of tar archives (archive, member, line_no, line), one task an archive, streamed from any store that pyarrow can open.

    An archive can't be split, so it is one task; its lines are read as they come and
    never held together.  Members that aren't files have no lines; bytes that are no UTF-8 are replaced.
    """

    class Reader(DataSourceReader):
        def partitions(self) -> Sequence[InputPartition]:
            return [_Archive(p) for p in paths]

        def read(self, partition: _Archive) -> Iterator[tuple]:
            import pyarrow.fs as fs

            where = partition.path if "://" in partition.path or partition.path.startswith("/") else "/" + partition.path.removeprefix("file:").lstrip("/")
            store, at = fs.FileSystem.from_uri(where)
            with store.open_input_stream(at, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|*") as archive:
                for member in archive:
                    if member.isfile():
                        for n, raw in enumerate(archive.extractfile(member)):
                            yield partition.path, member.name, n, raw.decode("utf-8", "replace").rstrip("\n")

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return "archive_lines"

        def schema(self) -> str:
            return "archive string, member string, line_no long, line string"

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format("archive_lines").load()


#: The layout of an act's section file.
SECTIONS = "handle string, sectionCount long, sections array<struct<sectionNo:string,label:string,content:string,footnote:string,sectionId:string>>"


def act_sections(spark: SparkSession, path: str) -> DataFrame:
    """Sections of acts' JSON files, each file one act: handle, order, section_no, label, content, footnote, section_id, and ``complete``, whether as many are there as the file says.

    Files that aren't such JSON, and acts without sections, have no rows.
    """
    files = spark.read.schema(SECTIONS + ", _bad string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    rows = files.select("handle", (F.col("sectionCount") == F.size("sections")).alias("complete"), F.posexplode("sections").alias("order", "s"))
    return rows.select("handle", "order", F.col("s.sectionNo").alias("section_no"), F.col("s.label").alias("label"), F.col("s.content").alias("content"), F.col("s.footnote").alias("footnote"), F.col("s.sectionId").alias("section_id"), "complete")


def act_texts(sections: DataFrame) -> DataFrame:
    """One text per act (handle) of its sections in order, each with its heading and footnotes, parted by a blank line; sections without any text are left out."""
    rows = sections.withColumn("text", section_to_text(F.col("section_no"), F.col("label"), F.col("content"), F.col("footnote"))).filter("text <> ''")
    ordered = F.array_sort(F.collect_list(F.struct("order", "text")))
    return rows.groupBy("handle").agg(F.count("*").alias("sections"), F.array_join(F.transform(ordered, lambda x: x["text"]), "\n\n").alias("text"))
