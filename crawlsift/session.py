"""Session-level helpers: shipping the package, the shared work folder, size-checked broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side may be broadcast only while its proven upper bound stays below this many bytes.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

#: Settings the jobs are designed for. Byte-bounded Arrow batches keep a batch of pages or
#: images small whatever their size; adaptive execution splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}

#: Rows and bytes of an Arrow batch that sessions are bounded to: texts and images may be very long.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20

_attached: set[str] = set()
_local_work_dirs: dict[str, str] = {}


def attach(spark: SparkSession) -> SparkSession:
    """Ship this package to the Python workers and register its data sources (idempotent)."""
    app = spark.sparkContext.applicationId
    if app not in _attached:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="crawlsift-pkg-"), "crawlsift")
        archive = shutil.make_archive(
            target, "zip", root_dir=os.path.dirname(package), base_dir="crawlsift"
        )
        spark.sparkContext.addPyFile(archive)
        _attached.add(app)
    from crawlsift.sinks.record_files import RecordFilesDataSource
    from crawlsift.sources.warc import WarcDataSource

    spark.dataSource.register(WarcDataSource)
    spark.dataSource.register(RecordFilesDataSource)
    return bound_batches(spark)


def bound_batches(spark: SparkSession) -> SparkSession:
    """Hold a session's Arrow batches to a size at which a worker's memory does not depend on how
    many rows a task has."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        size = spark.conf.get(name).removesuffix("b")
        if not size.isdecimal() or not 0 < int(size) <= most:
            spark.conf.set(name, str(most))
    return spark


def read_by_rows(spark: SparkSession) -> SparkSession:
    """Read Parquet columns of structs, such as pixels, row by row in this session.

    Batches of the vectorized reader have 4,096 rows whatever these weigh, in one array each: of
    images that is hundreds of megabytes a task. Plain columns are read as before.
    """
    spark.conf.set("spark.sql.parquet.enableNestedColumnVectorizedReader", "false")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder the cluster gives in ``spark.checkpoint.dir``.

    Only a local run may do without that setting: it uses a temporary folder. On a cluster every
    machine would write to its own disk, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        app = spark.sparkContext.applicationId
        if app not in _local_work_dirs:
            _local_work_dirs[app] = tempfile.mkdtemp(prefix="crawlsift-work-")
        base = _local_work_dirs[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared work folder and return a reader of it.

    Used where a result feeds several consumers: later plans prune columns of the written
    table, and a lost executor re-reads files instead of repeating the extraction.
    """
    spark = df.sparkSession
    target = folder or work_dir(spark, name)
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def release_memory() -> None:
    """Give memory that a Python worker no longer uses back to the system.

    Workers are kept for later tasks; what their allocators hold on to meanwhile adds up beside
    the executor's own heap.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has this call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def broadcast_if_bounded(df: DataFrame, max_rows: int, row_bytes: int = 256) -> DataFrame:
    """Hint a broadcast only when ``max_rows`` (a proven bound) keeps the side small.

    Beyond the bound the frame is returned unhinted, so the adaptive planner shuffles it.
    """
    if max_rows * row_bytes <= BROADCAST_LIMIT_BYTES:
        return F.broadcast(df)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for CPU-bound work on a table that few tasks would scan.

    Only a scan with fewer partitions than the cluster has cores is redistributed; a large
    table, which has many times more, is left alone and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
