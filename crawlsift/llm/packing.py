"""Token ids packed into fixed-length rows and written as binary matrices.

Documents are tokenised and cut, without loss, into pieces of at most ``seq_len`` ids; whole rows
stand alone and the rests are packed by best-fit decreasing: longest first, each into the row
with the least room that still holds it. A segment tree over room sizes finds that row in
``log(seq_len)`` steps.

A task packs its own rows of the table in groups of about ``shard_ids`` ids, so nothing is
shuffled, memory is bounded, and a repeated task writes the same files again. Rows of a group are
filled nearly to the end, so larger groups would save almost nothing.

A shard is one ``.npz`` file (uncompressed, readable by ``numpy.load``) with these arrays:

=============== ==================================================================
ids             matrix rows x seq_len, unused places hold ``pad_id``
cu_seqlens      per row: 0, then the end of each segment; rows one after another
row_splits      where each row's part of ``cu_seqlens`` begins, and the end
position_resets flat places in ``ids`` where positions start again at 0
doc_ids         document of each segment (and ``doc_known``: false where it is null)
doc_offsets     place of each segment's first id in its document
=============== ==================================================================

Rows of the table: null and empty texts have no ids and no segment. Rows with equal or null ids
are packed like any other. Very long texts become many whole rows. Other columns are ignored.
White space of more than ``BLANK_RUN`` characters in a row, on which the library's pattern runs out
of stack, is cut out and encoded as the one or two pieces that the pattern makes of it.
"""

from __future__ import annotations

import base64
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsift.llm.common import frugal, ready
from crawlsift.session import work_dir
from crawlsift.sinks.record_files import write_record_files

# Fixed values.
#: How the byte-level vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEQ_LEN = 2048
BLANK_RUN = 10_000
PAD_ID = 50256
SHARD_IDS = 1 << 22
PACKED_SCHEMA = (
    "shard string, row int, input_ids array<int>, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, doc_offsets array<long>"
)


@dataclass
class Tokenizer:
    """A byte-level BPE vocabulary in rank-file form; the file's bytes travel to the workers."""

    ranks: bytes
    pattern: str = PATTERN

    @classmethod
    def load(cls, path: str) -> "Tokenizer":
        with open(path, "rb") as file:
            return cls(file.read())

    def open(self):
        """Function from text to a numpy array of ids."""
        import tiktoken

        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, self.ranks.splitlines())}
        encoding = tiktoken.Encoding("packed", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        # White space as the vocabulary's pattern knows it (Unicode's, without \x1c to \x1f).
        run = re.compile(r"[^\S\x1c-\x1f]{%d,}" % BLANK_RUN)

        def encode(text: str) -> np.ndarray:
            parts, at = [], 0
            for found in run.finditer(text):
                # The pattern leaves a run's last character to the word that follows.
                end = found.end() - (found.end() < len(text))
                parts += [encoding.encode_ordinary(text[at : found.start()]), encoding._encode_single_piece(text[found.start() : end])]
                at = end
            parts.append(encoding.encode_ordinary(text[at:]))
            return np.concatenate([np.array(ids, dtype=np.uint32) for ids in parts])

        return encode


class RoomTree:
    """Segment tree over room sizes 0..size: which sizes some open row has."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.full = [False] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node and not self.full[node]:
            self.full[node] = True
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return ``(room, row)`` of the smallest room of at least ``least``."""
        node = self.leaves + least
        while not self.full[node]:
            while node & 1:  # a right child: go up until there is a right sibling
                node >>= 1
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.full[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            while node:
                self.full[node] = node < self.leaves and (self.full[2 * node] or self.full[2 * node + 1])
                node >>= 1
        return room, row


def best_fit(lengths: list[int], seq_len: int) -> list[list[int]]:
    """Pieces (by number) of each row: best-fit decreasing; ties go by number."""
    rows: list[list[int]] = []
    tree = RoomTree(seq_len)
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[piece])
        room, row = found if found else (seq_len, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(piece)
        if room > lengths[piece]:
            tree.add(room - lengths[piece], row)
    return rows


def pack(docs: list[tuple[int | None, np.ndarray]], seq_len: int, pad_id: int) -> dict[str, np.ndarray]:
    """The arrays of one shard."""
    pieces = [
        (doc, at, ids[at : at + seq_len])
        for doc, ids in docs
        for at in range(0, len(ids), seq_len)
    ]
    rows = best_fit([len(p[2]) for p in pieces], seq_len)
    kind = np.uint16 if max(pad_id, max((int(ids.max()) for _, ids in docs if len(ids)), default=0)) < 1 << 16 else np.uint32
    matrix = np.full((len(rows), seq_len), pad_id, dtype=kind)
    ends, resets, owners = [], [], []
    for n, row in enumerate(rows):
        ends.append(np.cumsum([0] + [len(pieces[p][2]) for p in row]))
        resets.append(n * seq_len + ends[-1][:-1])
        matrix[n, : ends[-1][-1]] = np.concatenate([pieces[p][2] for p in row])
        owners += [pieces[p][:2] for p in row]
    empty = [np.empty(0, dtype=np.int64)]
    return {
        "ids": matrix,
        "cu_seqlens": np.concatenate(ends or empty).astype(np.int32),
        "row_splits": np.cumsum([0] + [len(e) for e in ends]),
        "position_resets": np.concatenate(resets or empty).astype(np.int64),
        "doc_ids": np.array([d or 0 for d, _ in owners], dtype=np.int64),
        "doc_known": np.array([d is not None for d, _ in owners], dtype=bool),
        "doc_offsets": np.array([at for _, at in owners], dtype=np.int64),
    }


def position_ids(shard: dict[str, np.ndarray]) -> np.ndarray:
    """Position of every place of the id matrix within its segment."""
    ids = shard["ids"]
    last = np.zeros(ids.size, dtype=np.int64)
    last[shard["position_resets"]] = shard["position_resets"]
    return (np.arange(ids.size) - np.maximum.accumulate(last)).reshape(ids.shape)


def pack_shards(
    docs: DataFrame,
    tokenizer: Tokenizer,
    seq_len: int = SEQ_LEN,
    pad_id: int = PAD_ID,
    shard_ids: int = SHARD_IDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(name, body)``: one row per shard file."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(tokenizer)
    slim = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = shared.value.open()
        part = TaskContext.get().partitionId()
        held: list[tuple[int | None, np.ndarray]] = []
        size = written = 0

        def shard() -> pa.RecordBatch:
            nonlocal held, size, written
            body = io.BytesIO()
            np.savez(body, **pack(held, seq_len, pad_id))
            name = f"shard-{part:06d}-{written:04d}.npz"
            held, size, written = [], 0, written + 1
            return pa.RecordBatch.from_pydict({"name": [name], "body": [body.getvalue()]})

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) if text else ()
                if len(ids):
                    held.append((doc, ids.astype(np.uint16) if ids.max() < 1 << 16 else ids))
                    size += len(ids)
                    if size >= shard_ids:
                        yield shard()
        if held:
            yield shard()

    return slim.mapInArrow(frugal(run), "name string, body binary")


def read_packed(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of all shards below ``directory``: ids, segment ends, resets and segment owners."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = dict(np.load(io.BytesIO(body.as_buffer())))
                yield _shard_batch(name, shard)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(directory)
    return files.select(F.element_at(F.split("path", "/"), -1), "content").mapInArrow(frugal(rows), PACKED_SCHEMA)


def _shard_batch(name: str, shard: dict[str, np.ndarray]) -> pa.RecordBatch:
    n, seq_len = shard["ids"].shape
    splits = shard["row_splits"]
    segments = splits - np.arange(n + 1)  # a row has one end more than segments
    within = shard["position_resets"] - np.repeat(np.arange(n) * seq_len, np.diff(segments))

    def lists(at: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)

    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * n),
            pa.array(np.arange(n, dtype=np.int32)),
            lists(np.arange(n + 1) * seq_len, pa.array(shard["ids"].ravel().astype(np.int32))),
            lists(splits, pa.array(shard["cu_seqlens"])),
            lists(segments, pa.array(within.astype(np.int32))),
            lists(segments, pa.array(shard["doc_ids"], mask=~shard["doc_known"])),
            lists(segments, pa.array(shard["doc_offsets"])),
        ],
        names=["shard", "row", "input_ids", "cu_seqlens", "position_resets", "doc_ids", "doc_offsets"],
    )


def write_packed(docs: DataFrame, directory: str, tokenizer: Tokenizer, **options) -> None:
    """Write the shards of ``docs`` as files below ``directory``."""
    write_record_files(pack_shards(docs, tokenizer, **options), directory)


def packed(docs: DataFrame, tokenizer: Tokenizer, directory: str | None = None, **options) -> DataFrame:
    """Write the shards and read them back as one row per packed row."""
    spark = docs.sparkSession
    directory = directory or work_dir(spark, "packed")
    write_packed(docs, directory, tokenizer, **options)
    return read_packed(spark, directory)
