"""Minimal perfect hashing of a set of distinct 64-bit keys, built in Spark bucket by bucket.

A bucket's keys are thrown into a row of slots; a key alone in its slot sets the slot's bit, the
others go to a next, smaller row, until none is left. A key's number is the count of bits before
its own, over all buckets, so ``n`` keys have the numbers 0 to ``n - 1``. Keys outside the set get
some number, too: callers keep the key of each number and compare.

Rows: repeated keys count once, null keys not at all; an empty table gives a hash of no keys.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsift.llm.common import frugal, map_arrow

# Fixed values.
_GOLDEN = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_BUCKET_SEED = 1 << 20
SLOTS_PER_KEY = 1.5
LEVELS = 64
#: Distinct keys a bucket has on average.
BUCKET_KEYS = 16_384


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Keys scattered over 64 bits, one to one for each seed."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * _GOLDEN & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys, _BUCKET_SEED) % np.uint64(buckets)).astype(np.int64)


def bucket_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bits of each row of slots for distinct ``keys``."""
    levels = []
    while len(keys):
        if len(levels) == LEVELS:
            raise ValueError("keys are not distinct")
        slots = max(1, int(SLOTS_PER_KEY * len(keys)))
        at = (mixed(keys, len(levels)) % np.uint64(slots)).astype(np.int64)
        alone = np.bincount(at, minlength=slots) == 1
        levels.append(alone)
        keys = keys[~alone[at]]
    return levels


@dataclass
class PerfectHash:
    """``slots[bucket, level]`` and ``starts`` of each row of slots in ``bits``."""

    slots: np.ndarray
    starts: np.ndarray
    bits: np.ndarray
    before: np.ndarray

    @classmethod
    def of_levels(cls, rows: list[tuple[int, int, int, bytes]], buckets: int) -> "PerfectHash":
        """From ``(bucket, level, slots, packed bits)`` rows."""
        depth = max((level for _, level, _, _ in rows), default=-1) + 1
        slots = np.zeros((buckets, depth), dtype=np.int64)
        starts = np.zeros((buckets, depth), dtype=np.int64)
        parts, end = [np.zeros(0, dtype=bool)], 0
        for bucket, level, size, packed in sorted(rows):
            slots[bucket, level], starts[bucket, level] = size, end
            parts.append(np.unpackbits(np.frombuffer(packed, dtype=np.uint8), count=size).astype(bool))
            end += size
        bits = np.concatenate(parts)
        return cls(slots, starts, bits, np.cumsum(bits) - bits)

    def __len__(self) -> int:
        return int(self.bits.sum())

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of every key; -1 or some number for keys outside the set."""
        found = np.full(len(keys), -1, dtype=np.int64)
        at = np.arange(len(keys))
        bucket = buckets_of(keys, len(self.slots))
        for level in range(self.slots.shape[1]):
            slots = self.slots[bucket, level]
            at, bucket, slots = at[slots > 0], bucket[slots > 0], slots[slots > 0]
            if not len(at):
                break
            place = self.starts[bucket, level] + (mixed(keys[at], level) % slots.view(np.uint64)).astype(np.int64)
            hit = self.bits[place]
            found[at[hit]] = self.before[place[hit]]
            at, bucket = at[~hit], bucket[~hit]
        return found


def build(keys: DataFrame, key: str, bound: int) -> PerfectHash:
    """Perfect hash of the distinct values of a long column, of which there are at most ``bound``.

    The keys of a bucket meet in one task; only the bits, some 3 a key, come to the driver.
    """
    buckets = max(1, -(-bound // BUCKET_KEYS))

    def deal(batch: pa.RecordBatch) -> dict:
        found = batch.column(0).to_numpy(zero_copy_only=False)
        return {"bucket": buckets_of(found, buckets).astype(np.int32), "key": found}

    distinct = keys.select(F.col(key).cast("long").alias("key")).where("key IS NOT NULL").distinct()
    dealt = map_arrow(distinct, deal, "bucket int, key long")

    def levels(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        found = bucket_levels(table.column("key").to_numpy())
        return pa.table(
            {
                "bucket": pa.array([bucket] * len(found), pa.int32()),
                "level": pa.array(range(len(found)), pa.int32()),
                "slots": pa.array([len(bits) for bits in found], pa.int64()),
                "bits": pa.array([np.packbits(bits).tobytes() for bits in found], pa.binary()),
            }
        )

    rows = dealt.groupBy("bucket").applyInArrow(levels, "bucket int, level int, slots long, bits binary").collect()
    return PerfectHash.of_levels([(r.bucket, r.level, r.slots, bytes(r.bits)) for r in rows], buckets)


def dense_sums(counts: DataFrame, key: str, n: str, hashed: PerfectHash, fan_in: int = 32, chunk: int = 8192) -> DataFrame:
    """``(chunk, sums)``: dense vectors of the sums of ``n`` by key number, in chunks of ``chunk``.

    Every task turns its rows into one dense vector; vectors are added ``fan_in`` at a time, in as
    many rounds as their number asks for, each round in parallel over vectors and chunks.
    """
    size = len(hashed)
    shared = counts.sparkSession.sparkContext.broadcast(hashed)

    def vector(batches):
        from pyspark import TaskContext

        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            keys, values = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            np.add.at(total, shared.value.numbers(keys), values)
        part = TaskContext.get().partitionId()
        starts = range(0, size, chunk)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part] * len(starts), pa.int32()),
                "chunk": pa.array([s // chunk for s in starts], pa.int32()),
                "sums": pa.array([total[s : s + chunk].tobytes() for s in starts], pa.binary()),
            }
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), dtype=np.int64) for v in table.column("sums"))
        first = table.slice(0, 1)
        return pa.table({"part": first.column("part"), "chunk": first.column("chunk"), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, chunk int, sums binary"
    slim = counts.select(F.col(key).cast("long"), F.col(n).cast("long"))
    parts = slim.rdd.getNumPartitions()
    vectors = slim.mapInArrow(frugal(vector), schema)
    while True:
        parts = -(-parts // fan_in)
        vectors = vectors.withColumn("part", (F.col("part") / fan_in).cast("int"))
        vectors = vectors.groupBy("part", "chunk").applyInArrow(add, schema)
        if parts <= 1:
            return vectors.select("chunk", "sums")
