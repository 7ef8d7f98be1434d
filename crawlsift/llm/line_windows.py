"""Line deduplication by overlapping windows of three lines.

Every run of three consecutive lines (blank lines aside) is hashed; windows that occur again
anywhere later, in order of document id and position, are later occurrences. The lines they cover
are merged over overlapping windows and removed; the first occurrence keeps its lines, unless
another repeat covers them. Each removed line's first occurrence is kept, so no line vanishes.

Only hashes are shuffled to find repeats, pre-aggregated; a hash that a large share of all windows
has is dealt to many tasks. Removed places are gathered per document, whose text is as long. Texts
that lose nothing stay where they are, told apart by a bit filter of fixed size; the others are
shuffled to their removed places.

Rows: null and empty texts have no lines and stay as they are, as do texts of fewer than three
lines. Lines are compared without surrounding ASCII white space. Null ids sort last. Rows that repeat an
id are told apart by a hash of their text; rows equal in both are one document in this operator:
they are cleaned alike. Other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from collections.abc import Iterator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.llm.common import free_name, frugal, join_hot, may_hold, ready
from crawlsift.session import materialize

# Fixed values.
WINDOW_LINES = 3
_WHITE_SPACE = " \t\n\x0b\x0c\r"
_BATCH_WINDOWS = 1 << 16


def _lines(text: str | None) -> tuple[list[str], list[int]]:
    """All lines, and the numbers of those that are not blank."""
    lines = text.split("\n") if text else []
    return lines, [i for i, line in enumerate(lines) if line.strip(_WHITE_SPACE)]


def line_windows(docs: DataFrame, id_col: str, text_col: str, size: int = WINDOW_LINES) -> DataFrame:
    """``(doc, body, at, window)``: place and 128-bit hash of every window."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    slim = slim.select("doc", "text", F.xxhash64("text").alias("body"))
    schema = "doc long, body long, at int, window binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, bodies, places, hashes = [], [], [], []
            for doc, text, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines, full = _lines(text)
                stripped = [lines[i].strip(_WHITE_SPACE).encode() for i in full]
                for at in range(len(stripped) - size + 1):
                    docs.append(doc)
                    bodies.append(body)
                    places.append(at)
                    hashes.append(xxhash.xxh3_128_digest(b"\n".join(stripped[at : at + size])))
                if len(docs) >= _BATCH_WINDOWS:
                    yield _windows(docs, bodies, places, hashes)
                    docs, bodies, places, hashes = [], [], [], []
            if docs:
                yield _windows(docs, bodies, places, hashes)

    return slim.mapInArrow(frugal(run), schema)


def _windows(docs, bodies, places, hashes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64()), pa.array(bodies, pa.int64()), pa.array(places, pa.int32()), pa.array(hashes, pa.binary())],
        names=["doc", "body", "at", "window"],
    )


def repeated_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_LINES) -> DataFrame:
    """``(doc, body, places)``: first lines of all later occurrences in each document that has any."""
    windows = materialize(line_windows(docs, id_col, text_col, size), "windows")
    first = F.min(F.struct(F.col("doc").isNull().alias("nameless"), "doc", "body", "at")).alias("first")
    groups = (
        windows.groupBy("window")
        .agg(F.count(F.lit(1)).alias("times"), first)
        .where("times > 1")
        .select("window", "times", F.col("first.doc").alias("doc1"), F.col("first.body").alias("body1"), F.col("first.at").alias("at1"))
    )
    joined = join_hot(windows, groups, "window", "times", windows.count(), F.xxhash64("doc", "body", "at"))
    is_first = F.col("doc").eqNullSafe(F.col("doc1")) & (F.col("body") == F.col("body1")) & (F.col("at") == F.col("at1"))
    return joined.where(F.col("times").isNotNull() & ~is_first).groupBy("doc", "body").agg(F.collect_set("at").alias("places"))


def remove_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    total_col: str = "n_lines",
    removed_col: str = "n_removed",
    size: int = WINDOW_LINES,
) -> DataFrame:
    """``docs`` with later occurrences cut out of the text, and counts of lines and removed lines.

    Columns of the new names are replaced.
    """
    ready(docs.sparkSession)
    docs = docs.drop(total_col, removed_col)
    doc, body, places, hit = (free_name(docs, c) for c in ("_doc", "_body", "_places", "_hit"))
    found = materialize(repeated_places(docs, id_col, text_col, size).toDF(doc, body, places), "places")
    # The body's hash alone says whether a text may lose lines; equal texts mostly do together.
    text_hash = F.xxhash64(F.col(text_col).cast("string"))
    marked = may_hold(docs, text_hash, found, F.col(body), hit)
    looked_up = (
        marked.where(hit)
        .join(found, F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (text_hash == F.col(body)), "left")
        .drop(doc, body, hit)
    )
    in_place = marked.where(~F.col(hit)).drop(hit).withColumn(places, F.lit(None).cast("array<int>"))
    joined = in_place.union(looked_up)
    at = docs.columns.index(text_col)
    fields = [T.StructField(f.name, T.StringType()) if f.name == text_col else f for f in docs.schema.fields]
    schema = T.StructType([*fields, T.StructField(total_col, T.LongType()), T.StructField(removed_col, T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts, totals, removed = [], [], []
            for text, starts in zip(columns[at].cast(pa.large_string()).to_pylist(), columns[-1].to_pylist()):
                lines, full = _lines(text)
                gone = np.zeros(len(full), dtype=bool)
                for k in range(size if starts else 0):
                    gone[np.array(starts) + k] = True
                drop = {full[i] for i in np.nonzero(gone)[0]}
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text)
                totals.append(len(lines))
                removed.append(len(drop))
            kind = columns[at].type
            columns[at] = pa.array(texts, kind)
            yield pa.RecordBatch.from_arrays(
                [*columns[:-1], pa.array(totals, pa.int64()), pa.array(removed, pa.int64())], names=[f.name for f in schema]
            )

    return joined.mapInArrow(frugal(cut), schema)
