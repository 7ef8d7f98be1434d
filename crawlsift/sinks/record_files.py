"""One file per row: ``df.write.format("record_files")``."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from crawlsift.functions.naming import alt_metadata, export_name, pair_directory
from crawlsift.session import release_memory
from crawlsift.sources.paths import open_fs, replace_file

# Object stores show a file only once it is complete, so nothing is renamed.
ATOMIC_STORES = ("s3", "gcs", "abfs")
#: Files of an object store that are moved at a time.
SWITCH_THREADS = 32


@dataclass
class Written(WriterCommitMessage):
    files: int


class RecordFilesWriter(DataSourceArrowWriter):
    """Writes column ``body`` under the relative path in column ``name``.

    A job has a folder of its own below the directory, whose name starts with a dot; commit and
    abort clear it (a task that outlives its job's abort may leave some of it, which no reader
    sees and the next overwrite clears). Tasks write files there and rename them to their place (object stores show a
    file only once it is complete, so nothing is renamed there). Names and bodies come from the row
    alone, so a repeated or speculative task writes the same files again and nothing has to pass
    the driver but the number of files.

    With ``overwrite`` the whole output is staged in that folder and takes the place of the old one
    at commit, so a job that fails leaves the old output as it was.
    """

    def __init__(self, directory: str, overwrite: bool = False):
        self.directory = directory
        self.overwrite = overwrite
        self.job = f".job-{uuid.uuid4().hex}"

    def _places(self) -> tuple[pafs.FileSystem, str, str]:
        """File system, the output directory, and where its files are put for now."""
        fs, base = open_fs(self.directory)
        base = base.rstrip("/")
        return fs, base, f"{base}/{self.job}/staged" if self.overwrite else base

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base, place = self._places()
        attempt = f"{base}/{self.job}/{uuid.uuid4().hex}"
        atomic = fs.type_name in ATOMIC_STORES
        known: set[str] = set()
        count = 0
        for batch in iterator:
            for name, body in zip(batch.column("name"), batch.column("body")):
                relative = name.as_py()
                if relative is None or ".." in relative.split("/"):
                    raise ValueError(f"not a relative file name: {relative!r}")
                path = f"{place}/{relative}"
                for folder in (path.rsplit("/", 1)[0], attempt.rsplit("/", 1)[0]):
                    if not atomic and folder not in known:
                        fs.create_dir(folder, recursive=True)
                        known.add(folder)
                target = path if atomic else attempt
                with fs.open_output_stream(target, compression=None) as stream:
                    stream.write(body.as_py() or b"")
                if not atomic:
                    replace_file(fs, target, path)
                count += 1
        release_memory()
        return Written(count)

    def commit(self, messages) -> None:
        fs, base, place = self._places()
        fs.create_dir(base, recursive=True)
        if self.overwrite:
            fs.create_dir(place, recursive=True)
            old = [e for e in fs.get_file_info(pafs.FileSelector(base)) if e.base_name != self.job]
            self._switch(fs, base, place, old)
        self._clear(fs, base)
        with fs.open_output_stream(f"{base}/_SUCCESS"):
            pass

    def _switch(self, fs: pafs.FileSystem, base: str, place: str, old: list[pafs.FileInfo]) -> None:
        """Put the staged files in the place of the old ones, which wait in the job's folder."""
        if fs.type_name in ATOMIC_STORES:  # no folders to rename: files are moved side by side
            staged = [e.path for e in fs.get_file_info(pafs.FileSelector(place, recursive=True)) if e.type == pafs.FileType.File]
            new = {f"{base}{path.removeprefix(place)}" for path in staged}
            with ThreadPoolExecutor(SWITCH_THREADS) as pool:
                list(pool.map(lambda path: fs.move(path, f"{base}{path.removeprefix(place)}"), staged))
                left = [e.path for o in old for e in _files(fs, o) if e.path not in new]
                list(pool.map(fs.delete_file, left))
            return
        away = f"{base}/{self.job}/old"
        fs.create_dir(away, recursive=True)
        for entry in old:
            fs.move(entry.path, f"{away}/{entry.base_name}")
        for entry in fs.get_file_info(pafs.FileSelector(place)):
            fs.move(entry.path, f"{base}/{entry.base_name}")

    def abort(self, messages) -> None:
        """What an appending job has written stays, as names are stable; the marker is missing."""
        fs, base, _ = self._places()
        self._clear(fs, base)

    def _clear(self, fs: pafs.FileSystem, base: str) -> None:
        if fs.get_file_info(f"{base}/{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/{self.job}")


def _files(fs: pafs.FileSystem, entry: pafs.FileInfo) -> list[pafs.FileInfo]:
    if entry.type != pafs.FileType.Directory:
        return [entry]
    return [e for e in fs.get_file_info(pafs.FileSelector(entry.path, recursive=True)) if e.type == pafs.FileType.File]


class RecordFilesDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_files"

    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField("name", T.StringType()), T.StructField("body", T.BinaryType())]
        )

    def writer(self, schema: T.StructType, overwrite: bool) -> RecordFilesWriter:
        return RecordFilesWriter(self.options["path"], overwrite)


def write_record_files(
    df: DataFrame,
    directory: str,
    name_col: str = "name",
    body_col: str = "body",
    mode: str = "append",
) -> None:
    """Write one file per row; ``name`` may hold folders. Names must be unique."""
    from crawlsift.session import attach

    attach(df.sparkSession)
    df.select(
        F.col(name_col).alias("name"), F.col(body_col).cast("binary").alias("body")
    ).write.format("record_files").mode(mode).save(directory)


def unique_name(name: Column, *keys: str) -> Column:
    """Insert a short hash of the row key before the extension, so that long URLs with a
    common prefix and equal scores do not overwrite one another."""
    suffix = F.substring(F.sha2(F.concat_ws("\n", *[F.col(k).cast("string") for k in keys]), 256), 1, 12)
    return F.concat(
        F.regexp_extract(name, r"^(.*)\.[^.]*$", 1),
        F.lit("-"),
        suffix,
        F.lit("."),
        F.regexp_extract(name, r"\.([^.]*)$", 1),
    )


def text_files(df: DataFrame, keys: tuple[str, ...] = ("url",)) -> DataFrame:
    """``(name, body)`` of exported texts."""
    name = export_name(F.col("url"), F.col("prediction"), "txt")
    return df.select(unique_name(name, *keys).alias("name"), F.col("export_text").alias("body"))


def image_files(df: DataFrame, keys: tuple[str, ...] = ("url",)) -> DataFrame:
    """``(name, body)`` of exported images: the original bytes under their own extension."""
    name = export_name(F.col("url"), F.col("prediction"), F.col("extension"))
    return df.select(unique_name(name, *keys).alias("name"), F.col("payload").alias("body"))


def _two_files(df: DataFrame, directory: Column, text: tuple, image: tuple) -> DataFrame:
    entries = [
        F.struct(
            F.concat(directory, F.lit("/"), name).alias("name"), body.cast("binary").alias("body")
        )
        for name, body in (text, image)
    ]
    return df.select(F.inline(F.array(*entries)))


def pair_files(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``(name, body)``: per pair a directory with the page text and the image."""
    score = F.col("prediction")
    folder = _unique_folder(
        pair_directory(F.col("text_url"), F.col("image_url"), score), keys
    )
    return _two_files(
        df,
        folder,
        (export_name(F.col("text_url"), score, "txt"), F.col("export_text")),
        (export_name(F.col("image_url"), score, F.col("extension")), F.col("payload")),
    )


def alt_pair_files(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``(name, body)``: per pair a directory with ``meta.txt`` and the image."""
    folder = _unique_folder(pair_directory(F.col("text_url"), F.col("image_url")), keys)
    meta = alt_metadata(
        F.col("prediction"), F.col("text_url"), F.col("image_url"), F.col("alt_text")
    )
    return _two_files(
        df,
        folder,
        (F.lit("meta.txt"), meta),
        (F.concat(F.lit("img."), F.col("extension")), F.col("payload")),
    )


def _unique_folder(folder: Column, keys: tuple[str, ...]) -> Column:
    suffix = F.substring(F.sha2(F.concat_ws("\n", *[F.col(k).cast("string") for k in keys]), 256), 1, 12)
    return F.concat(folder, F.lit("-"), suffix)


def write_pairs(df: DataFrame, directory: str, keys: tuple[str, ...], mode: str = "append") -> None:
    """Write page-image pairs, one directory per pair."""
    write_record_files(pair_files(df, keys), directory, mode=mode)


def write_alt_pairs(
    df: DataFrame, directory: str, keys: tuple[str, ...], mode: str = "append"
) -> None:
    """Write image-alt-text pairs, one directory per pair."""
    write_record_files(alt_pair_files(df, keys), directory, mode=mode)
