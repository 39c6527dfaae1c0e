"""Sources: JSON lines (plain, gzip, or in tar archives), CSV, partitioned Parquet, listings, samples."""

from __future__ import annotations

import json
import tarfile
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

BAD = "_bad"
#: Lines and bytes of a batch that a task reads from an archive.
BATCH_LINES, BATCH_BYTES = 4096, 4 << 20


def json_lines(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Good records, and the lines that aren't JSON; gzip files are read by name."""
    fields = StructType([*schema.fields, StructField(BAD, StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    rows = lines.select("value", F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("r"))
    return rows.filter(F.col(f"r.{BAD}").isNull()).select("r.*").drop(BAD), rows.filter(F.col(f"r.{BAD}").isNotNull()).select(F.col("value").alias(BAD))


def _batches(archive_name: str, stream: IO[bytes]) -> Iterator[pa.RecordBatch]:
    """Lines of an archive's members as they are read, so many at once that a batch stays small; a longer line is a batch of its own."""
    names = ["archive", "member", "line_no", "line"]
    with tarfile.open(fileobj=stream, mode="r|*") as archive:
        for member in archive:
            if not member.isfile():
                continue
            lines, first, held = [], 0, 0

            def batch(member: str, first: int, lines: list[str]) -> pa.RecordBatch:
                n = len(lines)
                return pa.RecordBatch.from_arrays([pa.array([archive_name] * n), pa.array([member] * n), pa.array(range(first, first + n), pa.int64()), pa.array(lines, pa.string())], names=names)

            for raw in archive.extractfile(member):
                if lines and (len(lines) == BATCH_LINES or held + len(raw) > BATCH_BYTES):
                    yield batch(member.name, first, lines)
                    lines, first, held = [], first + len(lines), 0
                lines.append(raw.decode("utf-8", "replace").rstrip("\n"))
                held += len(raw)
            if lines:
                yield batch(member.name, first, lines)


def tar_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the members of tar archives: archive, member, line_no, line.

    An archive on a mounted file system is streamed in one task, as gzip can't
    be split, and its lines are dealt out at once.  From any other store, which
    Spark alone may be able to read, Spark hands it over whole, of 2 GB at most.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open("/" + name.removeprefix("file:").lstrip("/"), "rb") as stream:
                    yield from _batches(name, stream)

    def members_of_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from _batches(name, pa.BufferReader(content.as_buffer()))

    schema = "archive string, member string, line_no long, line string"
    files = spark.read.format("binaryFile").load(path)
    if files.select("path").filter(~F.col("path").startswith("file:")).isEmpty():
        lines = files.select("path").mapInArrow(members, schema)
    else:
        lines = files.select("path", "content").mapInArrow(members_of_contents, schema)
    return lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_base_and_language(lines: DataFrame, pattern: str = r"(\d{4}_INSC_\d+)(?:_([A-Z]{2,4}))?\.chunks\.jsonl$") -> DataFrame:
    """``lines`` with base_id and lang by the member's name; both null where it doesn't fit."""
    base = F.nullif(F.regexp_extract("member", pattern, 1), F.lit(""))
    return lines.withColumns({"base_id": base, "lang": F.when(base.isNotNull(), F.coalesce(F.nullif(F.regexp_extract("member", pattern, 2), F.lit("")), F.lit("EN")))})


def csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def partitioned(spark: SparkSession, root: str) -> DataFrame:
    """Hive-partitioned Parquet: partition columns are found in the paths, and filters on them prune."""
    return spark.read.option("basePath", root).parquet(root)


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files with size and time; contents aren't read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    extension = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return found.select("path", "length", "modificationTime", extension.alias("extension"))


def needs_ocr(pages: Column, least: int = 200) -> Column:
    """Whether the first three pages hold fewer than so many characters."""
    return F.aggregate(F.slice(pages, 1, 3), F.lit(0), lambda n, p: n + F.length(F.trim(F.coalesce(p["text"], F.lit(""))))) < least


def sampled(rows: DataFrame, by: str, key: str, n: int, seed: int = 4242) -> DataFrame:
    """``n`` rows of each group, chosen by a seeded hash of the key, so the same ones each time."""
    order = W.partitionBy(by).orderBy(F.xxhash64(F.lit(seed), key), key)
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def field_map(raw: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """Target columns, each from the first raw column that has something, and ``raw_metadata`` with what no target takes."""
    used = {c for names in fields.values() for c in names}
    targets = [F.coalesce(*(F.nullif(F.col(c).cast("string"), F.lit("")) for c in names if c in raw.columns), F.lit(None)).alias(t) for t, names in fields.items()]
    rest = [c for c in raw.columns if c not in used]
    return raw.select(*targets, F.to_json(F.struct(*rest)).alias("raw_metadata") if rest else F.lit("{}").alias("raw_metadata"))


def judgment_filter(rule: str, column: Column, value: str = "") -> Column:
    """always_true, not_empty, equals or contains (a comma list), in any case."""
    text = F.lower(F.coalesce(column.cast("string"), F.lit("")))
    if rule == "always_true":
        return F.lit(True)
    if rule == "not_empty":
        return F.trim(text) != ""
    if rule == "equals":
        return text == value.lower()
    if rule == "contains":
        out = F.lit(False)
        for part in value.lower().split(","):
            out = out | text.contains(part.strip())
        return out
    raise ValueError(f"unknown rule: {json.dumps(rule)}")
