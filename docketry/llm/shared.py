"""The folder that driver and executors share, tables written there, and connected components."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one where that is unset and all of Spark is one process, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="docketry-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one, of which nothing is read any more."""
    if not path.startswith(shared_folder(spark) + "/"):
        raise ValueError(f"{path} isn't in the shared folder")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores added to those that are columns of ``frame``."""
    taken, out = {c.lower() for c in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


#: A key is hot if it has more than one row in so many.
HOT = 1000


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` joined with ``counted``, one row per key and ``c``, how many of the rows have it.

    Fewer than ``HOT`` keys can have more than one row in ``HOT`` of ``total``: these are broadcast, so that
    rows of a hot key stay where they are.  All other keys are joined by a shuffle, at every size.
    """
    is_hot = F.col("c") * HOT > F.lit(max(total, HOT))
    hot = counted.filter(is_hot)
    here = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(counted.filter(~is_hot).hint("merge"), keys)
    return here.unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (src, dst): one row (id, component) per vertex.

    The component is its smallest id.  Each round takes the smallest label
    among a vertex and its neighbours and then that label's own label, so the
    number of rounds follows the logarithm of the longest path.  Labels are
    checkpointed each round; only a count of changes reaches the driver.
    """
    spark = edges.sparkSession
    shared_folder(spark)
    both = written(
        edges.filter("src <> dst").select("src", "dst").unionByName(edges.filter("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(),
        "edges",
    )
    labels = both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("d")).select("id", F.least("id", "d").alias("component")).checkpoint()
    while True:
        near = both.join(labels.select(F.col("id").alias("dst"), "component"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id").select("id", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        own = lower.select(F.col("id").alias("component"), F.col("component").alias("own"))
        labels = lower.join(own, "component").select("id", "before", F.least("component", "own").alias("component")).checkpoint()
        if labels.filter("component <> before").isEmpty():
            return labels.select("id", "component")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Python workers get Arrow batches of few rows, as texts are long; a setting other than Spark's default stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(rows))


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on a partition's batches, after which free memory goes back to the system: workers live on, and later stages need it."""

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
                trim(0)

    return run
