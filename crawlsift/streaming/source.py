"""Archive records as a stream: ``spark.readStream.format("warc")``.

Archives are read in the order in which they were found. A folder that belongs to the query (the
log) keeps that order, one file of names and sizes per discovery; a place in the stream is a number
in the log and a byte of that archive. So an archive is read once, whatever its name and however
late it appears; a batch may end inside an archive; and a restarted query goes on at the byte where
its checkpoint says. A batch takes at most ``maxBytesPerTrigger`` bytes.

Records belong to the batch that holds the first byte of their gzip member, as they belong to a
byte range in a batch read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSourceStreamReader

from crawlsift.sources.paths import list_files, open_fs, replace_file
from crawlsift.sources.warc import ArchiveRange, RangeList, ReadOptions, share_tasks, split_archive

#: Bytes of archives that a batch takes at most.
DEFAULT_TRIGGER_BYTES = 16 << 30
_DIGITS = 12


class ArchiveLog:
    """Archives in the order of their discovery, as the files of a folder.

    A file is named by the number of its first archive and appears whole or not at all.
    """

    def __init__(self, folder: str):
        self.fs, base = open_fs(folder)
        self.base = base.rstrip("/")
        self.archives: list[tuple[str, int]] = []
        self.known: set[str] = set()

    def load(self) -> None:
        """Take in what has been written since."""
        while True:
            path = f"{self.base}/{len(self.archives):0{_DIGITS}d}.jsonl"
            if self.fs.get_file_info(path).type != pafs.FileType.File:
                return
            with self.fs.open_input_stream(path, compression=None) as stream:
                self._take([tuple(json.loads(line)) for line in stream.read().splitlines()])

    def _take(self, found: list[tuple[str, int]]) -> None:
        self.archives += found
        self.known.update(path for path, _ in found)

    def discover(self, roots: list[str], suffix: str) -> None:
        """Append the archives below the roots that are not in the log. Empty files may still be
        growing; they are left for later."""
        self.load()
        found = [(path, size) for path, size in list_files(roots, suffix) if size and path not in self.known]
        if not found:
            return
        self.fs.create_dir(self.base, recursive=True)
        target = f"{self.base}/{len(self.archives):0{_DIGITS}d}.jsonl"
        with self.fs.open_output_stream(f"{target}.new", compression=None) as stream:
            stream.write("".join(json.dumps(entry) + "\n" for entry in found).encode())
        replace_file(self.fs, f"{target}.new", target)
        self._take(found)


class WarcStreamReader(DataSourceStreamReader):
    def __init__(self, options, schema: T.StructType):
        if "log" not in options:
            raise ValueError("a stream of archives needs a log: a shared folder of its own")
        self.options = ReadOptions.of(options, schema)
        self.cap = int(options.get("maxBytesPerTrigger", DEFAULT_TRIGGER_BYTES))
        if self.cap <= 0:
            raise ValueError("maxBytesPerTrigger must be positive")
        self.least_parts = int(options.get("leastPartitions", 1))
        self.log_folder = options["log"]
        self.log: ArchiveLog | None = None
        self.planned: dict | None = None

    def _log(self) -> ArchiveLog:
        if self.log is None:
            self.log = ArchiveLog(self.log_folder)
            self.log.load()
        return self.log

    def initialOffset(self) -> dict:
        return {"archive": 0, "byte": 0}

    def latestOffset(self) -> dict:
        """The end of the next batch: ``cap`` bytes beyond the end of the last one planned."""
        start = self.planned or self.initialOffset()
        end, left = self._advance(start)
        if left > 0:  # what is known does not fill a batch
            self._log().discover(self.options.roots, self.options.suffix)
            end, _ = self._advance(start)
        return end

    def _advance(self, start: dict) -> tuple[dict, int]:
        """The place ``cap`` bytes on or the end of the log, and how many bytes were left."""
        archives = self._log().archives
        number, byte, left = start["archive"], start["byte"], self.cap
        while number < len(archives) and left > 0:
            step = min(left, archives[number][1] - byte)
            left -= step
            byte += step
            if byte >= archives[number][1]:
                number, byte = number + 1, 0
        return {"archive": number, "byte": byte}, left

    def partitions(self, start: dict, end: dict) -> list[RangeList]:
        self.planned = end  # a restarted query says by this where it stands
        archives = self._log().archives
        ranges = []
        for number in range(start["archive"], min(end["archive"] + 1, len(archives))):
            path, size = archives[number]
            first = start["byte"] if number == start["archive"] else 0
            last = end["byte"] if number == end["archive"] else size
            if first < last:
                ranges += [ArchiveRange(path, first + a, first + b, size) for a, b in split_archive(last - first, self.options.split)]
        return share_tasks(ranges, self.options.split, self.least_parts)

    def read(self, partition: RangeList) -> Iterator[pa.RecordBatch]:
        return self.options.read(partition)

    def commit(self, end: dict) -> None:
        """The checkpoint holds the place; the log grows by discoveries only."""
