"""Sinks: gated Parquet releases with manifest and checksums, JSON shards, CSV."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


class GateError(ValueError):
    """Rows that must not be published."""


def _move(spark: SparkSession, source: str, target: str | None) -> None:
    """Rename a folder, or delete it where there is no target."""
    at = spark._jvm.org.apache.hadoop.fs.Path(source)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if target is None:
        files.delete(at, True)
    elif not files.rename(at, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} can't be renamed to {target}")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def release(rows: DataFrame, path: str, schema: Sequence[str], by: str, quarantine: str | None = None) -> DataFrame:
    """Write zstd Parquet on a pinned schema, one folder per value of ``by``; returns the manifest.

    Rows go to a folder beside ``path`` first.  What was written there passes the gate and is
    renamed, so that readers see all of a release or nothing (as far as the file system's
    rename is atomic), or is deleted; the error names the first twenty rows that must not be
    published, and all of them go to the folder ``quarantine``, if one is named.  Rows of one
    value are spread over files, so a large one is no single task.
    """
    spark = rows.sparkSession
    if _exists(spark, path):
        raise FileExistsError(path)
    schemas.refuse_internal(rows)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    schemas.as_published(rows, list(schema)).withColumn(f"_{by}", F.col(by)).write.option("compression", "zstd").partitionBy(f"_{by}").parquet(staging)
    landed = spark.read.parquet(staging)
    refused = schemas.gate(landed.drop(f"_{by}"))
    problems = refused.select(schema[0], "reason").limit(20).collect()
    if problems:
        if quarantine:
            refused.write.mode("append").parquet(quarantine)
        _move(spark, staging, None)
        raise GateError("; ".join(f"{p[0]}: {p[1]}" for p in problems))
    _move(spark, staging, path)
    return manifest(spark.read.parquet(path), by)


def manifest(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), by)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and size of each file under ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def totals(spark: SparkSession, path: str, version: str) -> DataFrame:
    """One row on a release: version, files, rows and bytes."""
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    size = sizes.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
    return rows.crossJoin(size).select(F.lit(version).alias("version"), "files", "rows", "bytes")  # a row each


def json_shards(rows: DataFrame, path: str, by: str) -> None:
    """gzip JSON lines, one folder per value; empty texts and lists are left out like nulls."""
    kinds = dict(rows.dtypes)
    slim = rows.select(*(F.nullif(F.col(c), F.lit("")).alias(c) if kinds[c] == "string" else F.when(F.size(c) > 0, F.col(c)).alias(c) if kinds[c].startswith("array") else F.col(c) for c in rows.columns))
    slim.write.mode("overwrite").partitionBy(by).option("compression", "gzip").json(path)


def csv(rows: DataFrame, path: str, columns: Sequence[str]) -> None:
    rows.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def replace_groups(rows: DataFrame, path: str, by: str) -> None:
    """Write ``rows``, replacing only the groups that they have."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def invalid_outputs(chunks: DataFrame, required: Sequence[str], least: int = 100) -> DataFrame:
    """Rows without a required field or with too short a text; a column that is missing altogether is an error."""
    return chunks.filter(_lacking(chunks, required, least))


def _lacking(chunks: DataFrame, required: Sequence[str], least: int) -> Column:
    if missing := [c for c in required if c not in chunks.columns]:
        raise GateError(f"missing columns: {missing}")
    lacking = F.length(F.coalesce("text", F.lit(""))) < least
    for c in required:
        lacking = lacking | F.col(c).isNull()
    return lacking


def validated(chunks: DataFrame, wanted: DataFrame, document: str, required: Sequence[str], quarantine: str, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """Outputs of whole documents that are valid, and the rows of ``wanted`` that must be done again.

    A document with any invalid row is invalid as a whole: its rows go to the folder
    ``quarantine`` and it is done again, as is one of which no row is there.
    """
    bad = chunks.filter(_lacking(chunks, required, least)).select(document).distinct()
    chunks.join(bad, document, "left_semi").write.mode("append").parquet(quarantine)
    valid = chunks.join(bad, document, "left_anti")
    return valid, wanted.join(valid.select(document).distinct(), document, "left_anti")


# Characters of raw markup that an export keeps, and of dates.
MARKUP, DATE = 1000, 10


def registry_json(registry: DataFrame, courts: dict[str, str], path: str | None = None) -> DataFrame:
    """Registry rows as an export has them, and, with a path, written as JSON lines.

    Courts are named by code, or else by what the row says, or Unknown; dates keep their day;
    raw markup is cut; texts that are absent are empty, dates and markup null.
    """
    names = F.create_map(*(F.lit(x) for pair in courts.items() for x in pair))
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("cnr", "title", "court_code", "judge", "disposal_nature", "description", "pdf_link")}
    day = F.substring(F.col("decision_date").cast("string"), 1, DATE)
    out = registry.select(
        text["cnr"], text["title"], F.coalesce(F.try_element_at(names, F.col("court_code")), F.col("court"), F.lit("Unknown")).alias("court_name"), text["court_code"], day.alias("decision_date"), F.substring(day, 1, 4).try_cast("int").alias("decision_year"),
        F.substring(F.col("date_of_registration").cast("string"), 1, DATE).alias("date_of_registration"), text["judge"], text["disposal_nature"], text["description"], text["pdf_link"], F.coalesce(F.col("pdf_exists").cast("boolean"), F.lit(False)).alias("pdf_exists"),
        F.substring("raw_html", 1, MARKUP).alias("raw_html"),
    )
    if path:
        out.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
    return out
