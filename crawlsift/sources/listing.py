"""Archive listing."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsift.session import materialize
from crawlsift.sources.paths import open_fs, plain_path

#: Files that one task reads whole, and bytes of them in a batch.
FILES_PER_TASK = 5_000
_BATCH_BYTES = 8 << 20
_BATCH_ROWS = 4_096


def list_archives(
    spark: SparkSession, roots: str | list[str], suffix: str = ".warc.gz"
) -> DataFrame:
    """``(path, length, modificationTime)`` of all archives below the roots.

    File contents are not selected, so nothing but the listing is read.
    """
    paths = [roots] if isinstance(roots, str) else list(roots)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(paths)
        .select(plain_path(F.col("path")).alias("path"), "length", "modificationTime")
    )


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(path, length, folder)`` of what lies in folders."""
    for batch in batches:
        for root in batch.column(0).to_pylist():
            fs, inner = open_fs(root)
            prefix = root.rstrip("/").removesuffix(inner.rstrip("/"))
            found = [e for e in fs.get_file_info(pafs.FileSelector(inner)) if not _hidden(e.base_name) and (e.type == pafs.FileType.Directory or e.size)]
            for at in range(0, len(found), _BATCH_ROWS):
                part = found[at : at + _BATCH_ROWS]
                folder = [e.type == pafs.FileType.Directory for e in part]
                columns = [pa.array([prefix + e.path for e in part]), pa.array([e.size for e in part], pa.int64()), pa.array(folder)]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "length", "folder"])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[str, int, bytes]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.binary())
        columns = [pa.array(values, kind) for values, kind in zip(zip(*held), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["path", "length", "content"])

    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, inner = open_fs(path)
            with fs.open_input_stream(inner, compression=None) as stream:
                data = stream.read()
            held.append((path, len(data), data))
            size += len(data)
            if size >= _BATCH_BYTES or len(held) >= _BATCH_ROWS:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def read_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``(path, length, content)`` of all files below a folder whose name matches ``glob``, but empty
    ones, which Spark's readers pass over, too.

    For outputs of very many files: Spark's own file sources keep every file's status on the driver.
    Here tasks list folders, one level at a time, and read the files; the driver learns only how
    many there are.
    """
    cores = spark.sparkContext.defaultParallelism
    level = spark.createDataFrame([(root,)], "path string")
    files = None
    while True:
        # With its number given, adaptive execution does not pack the folders into one task.
        listed = level.repartition(4 * cores, "path").mapInArrow(_entries, "path string, length long, folder boolean")
        entries = materialize(listed, "listing")
        found = entries.filter(~F.col("folder")).select("path")
        files = found if files is None else files.union(found)
        level = entries.filter("folder").select("path")
        if level.isEmpty():
            break
    wanted = F.udf(lambda path: fnmatchcase(path.rsplit("/", 1)[-1], glob), "boolean")
    if glob != "*":
        files = files.filter(wanted("path"))
    tasks = max(cores, -(-files.count() // FILES_PER_TASK))
    return files.repartition(tasks, "path").mapInArrow(_contents, "path string, length long, content binary")
