"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A document is contaminated by an item of ``m`` words when some passage of it is within
``floor((1 - similarity) * m)`` word edits of the item (insertions, deletions, substitutions).

Every word position starts an item-sized window. An edit changes one word at most, so windows that
hold too few words of the items of that size, or too few of those items' rare words, cannot match
and are passed over, without loss. The rest are embedded by CGK random walks: at step ``j`` a walk emits the word it stands on and moves
on if random bit ``j`` of that word says so, so walks over texts a few edits apart fall back in
step and agree at most steps. A hash table samples a few steps, and has the items whose own walks
do not end before. How many tables are needed for the target recall is measured beforehand, per
size class, on edited copies of the items at the largest allowed distance, followed by other
words as in a document. Candidates are verified by their exact edit distance.

Other items are found without loss: those that allow no edit, and those of classes whose tables
miss the target recall at ``MAX_TABLES``. An item that allows ``e`` edits is cut into ``e + 1``
pieces; no edit touches one of them, so wherever the first words of a piece occur by their hash,
the passage around is a candidate.

Rows: null and empty texts match nothing; null, empty or punctuation-only items are left out, and
equal items under different ids are matched separately. Texts are compared in lower case, split
at ASCII white space and punctuation. Nothing is lost to long texts: they are handled whole.
Any other columns of the tables are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsift.llm.common import frugal, map_arrow, ready, utf8, word_chunks

# Fixed values.
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_TO_SPACE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
CLASS_RATIO = 1.15
#: A word is rare when no more than this share of the items has it.
RARE_SHARE = 0.01
TRIALS = 400
#: A class that needs more tables than this is looked up by pieces of its items instead.
MAX_TABLES = 400
TABLES_PER_WALK = 4
WINDOW_BLOCK = 65_536
#: Pieces of items are looked up by so many of their words at most.
PIECE_WORDS = 8
#: Short texts are joined up to so many words before windows are embedded.
JOINED_WORDS = 1 << 19
#: Items travel to the workers in slices of at most so many bytes; a larger benchmark takes
#: several passes over the documents.
SLICE_BYTES = 16 << 20


def words_of(data: bytes | None) -> Iterator[list[bytes]]:
    text = (data or b"").decode("utf-8", "replace").lower().encode()
    return word_chunks(text.translate(_TO_SPACE))


def allowed_edits(words: int, similarity: float) -> int:
    return int((1 - similarity) * words + 1e-9)


def passage_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any passage of ``text``, and where that passage ends."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype=np.int64)
    for word in item:
        new = np.empty_like(row)
        new[0] = row[0] + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(new - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


@dataclass
class SizeClass:
    """Items of nearly equal length and their hash tables."""

    items: list[int]
    reach: int  # words a passage may span
    #: Words of the items, and those few items share; a passage holds at least so many of each.
    words: np.ndarray
    needed: int
    rare: np.ndarray
    needed_rare: int
    #: Per walk: for each of its tables the sampled steps, sorted keys, and the items of the keys.
    walks: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]


class Index:
    """Hash tables over CGK walks of benchmark items; a pure function of items and settings."""

    def __init__(self, texts: list[bytes | None], similarity: float = 0.8, recall: float = 0.97, seed: int = 7):
        self.rng = np.random.default_rng(seed)
        self.similarity = similarity
        words = [[w for part in words_of(t) for w in part] for t in texts]
        self.vocabulary: dict[bytes, int] = {}
        for item in words:
            for word in item:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.pad = len(self.vocabulary) + 1
        self.items = [np.array([self.vocabulary[w] for w in item], dtype=np.int32) for item in words]
        self.edits = [allowed_edits(len(i), similarity) for i in self.items]
        self.bits = self.rng.integers(0, 1 << 63, self.pad + 1, dtype=np.uint64)
        spread = np.zeros(self.pad + 1, dtype=np.int64)
        for item in self.items:
            spread[np.unique(item)] += 1
        self.rare = spread <= max(1, int(RARE_SHARE * len(self.items)))
        pieces = [i for i in range(len(words)) if words[i] and not self.edits[i]]
        order = sorted((i for i in range(len(words)) if self.edits[i]), key=lambda i: len(words[i]))
        self.classes: list[SizeClass] = []
        while order:
            least = len(words[order[0]])
            same = [i for i in order if len(words[i]) <= least * CLASS_RATIO]
            order = order[len(same) :]
            shape = self._class(same, least, recall)
            if shape is None:
                pieces += same
            else:
                self.classes.append(shape)
        self.pieces = self._pieces(pieces)

    def _walk_bits(self, walk: int, block: int) -> np.ndarray:
        """64 random bits of every word, for steps ``64 * block`` and on of a walk."""
        bits = self.bits + np.uint64((walk << 32) + block)
        bits = (bits ^ (bits >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        bits = (bits ^ (bits >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return bits ^ (bits >> np.uint64(31))

    def _walk(self, text: np.ndarray, at: np.ndarray, limits: np.ndarray, steps: int, walk: int) -> np.ndarray:
        """CGK embedding: what walks starting at ``at`` emit (steps x starts). A walk stays at
        its limit, where ``text`` has the padding word."""
        out = np.empty((steps, len(at)), dtype=np.int32)
        for j in range(steps):
            if j % 64 == 0:
                bits = self._walk_bits(walk, j // 64)
            word = out[j] = text[at]
            at = np.minimum(at + ((bits[word] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64), limits)
        return out

    @staticmethod
    def _keys(words: np.ndarray) -> np.ndarray:
        """Hash of sampled words (samples x windows)."""
        key = np.zeros(words.shape[1], dtype=np.uint64)
        for row in words:
            key = (key ^ row.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key

    def _edited(self, item: np.ndarray, edits: int) -> np.ndarray:
        out = list(item)
        for _ in range(edits):
            kind, at = self.rng.integers(3), int(self.rng.integers(len(out) + 1))
            if kind == 0:
                out.insert(at, 0)
            elif out and kind == 1:
                del out[min(at, len(out) - 1)]
            elif out:
                out[min(at, len(out) - 1)] = 0
        return np.array(out, dtype=np.int32)

    def _joined(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts one after another, each followed by the padding word; starts and ends."""
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = ends - [len(t) for t in texts]
        pad = np.array([self.pad], dtype=np.int32)
        return np.concatenate([part for t in texts for part in (t, pad)]), starts, ends

    def _pieces(self, members: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By number of words: sorted keys of the items' pieces, their items and places in them.

        An item that allows ``e`` edits is cut into ``e + 1`` pieces, one of which no edit touches.
        """
        found: dict[int, list[tuple[int, int]]] = {}
        for i in members:
            cuts = [k * len(self.items[i]) // (self.edits[i] + 1) for k in range(self.edits[i] + 2)]
            for at, end in zip(cuts, cuts[1:]):
                found.setdefault(min(end - at, PIECE_WORDS), []).append((i, at))
        out = {}
        for size, places in found.items():
            keys = self._keys(np.array([self.items[i][at : at + size] for i, at in places]).T)
            order = np.argsort(keys, kind="stable")
            items, at = np.array(places, dtype=np.int64).T
            out[size] = keys[order], items[order], at[order]
        return out

    def _class(self, members: list[int], least: int, recall: float) -> SizeClass | None:
        """Tables of a class; None when they do not reach the recall."""
        if recall >= 1:
            return None
        length = 2 * least
        samples = min(length, 1 + int(np.ceil(np.log(len(members) + 1) / np.log(30))))
        own_words = np.zeros(self.pad + 1, dtype=bool)
        own_words[np.concatenate([self.items[i] for i in members])] = True
        shape = SizeClass(
            items=members,
            reach=max(len(self.items[i]) + self.edits[i] for i in members),
            words=own_words,
            needed=least - allowed_edits(least, self.similarity),
            rare=own_words & self.rare,
            # Each edit takes one word at most.
            needed_rare=min(int(self.rare[self.items[i]].sum()) - self.edits[i] for i in members),
            walks=[],
        )
        # Edited copies at the largest distance, with foreign words behind them for a walk to run
        # into; tables are added until enough of them are hit.
        trials = self.rng.integers(len(members), size=TRIALS)
        foreign = np.zeros(length, dtype=np.int32)
        copies = [np.concatenate((self._edited(self.items[members[k]], self.edits[members[k]]), foreign)) for k in trials]
        items, copies = self._joined([self.items[i] for i in members]), self._joined(copies)
        missed = np.ones(TRIALS, dtype=bool)
        while missed.mean() > 1 - recall:
            if len(shape.walks) * TABLES_PER_WALK >= MAX_TABLES:
                return None
            walk, tables = len(shape.walks), []
            own = self._walk(*items, length, walk)
            seen = self._walk(*copies, length, walk)
            for _ in range(TABLES_PER_WALK):
                steps = np.sort(self.rng.choice(length, samples, replace=False))
                keys = self._keys(own[steps])
                # A walk past its item's end stands on whatever follows: nothing to compare.
                inside = (own[steps] != self.pad).all(axis=0)
                missed &= (self._keys(seen[steps]) != keys[trials]) | ~inside[trials]
                order = np.argsort(keys, kind="stable")
                order = order[inside[order]]
                tables.append((steps, keys[order], np.array(members)[order]))
            shape.walks.append(tables)
        return shape

    def encode(self, data: bytes | None) -> np.ndarray:
        parts = [
            np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int32, count=len(words))
            for words in words_of(data)
        ]
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)

    def _piece_starts(self, text: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """``(item, starts)``: where a passage that holds a piece of the item begins, or up to
        twice the item's allowed edits before that."""
        for size, (keys, items, places) in self.pieces.items():
            at = np.arange(max(0, len(text) - size + 1))
            for k in range(size):
                at = at[(text[at + k] != 0) & (text[at + k] != self.pad)]
            for first in range(0, len(at), WINDOW_BLOCK):
                block = at[first : first + WINDOW_BLOCK]
                key = self._keys(np.stack([text[block + k] for k in range(size)]))
                low = np.searchsorted(keys, key)
                count = np.searchsorted(keys, key, side="right") - low
                hit = np.repeat(np.arange(len(block)), count)
                piece = np.repeat(low - np.cumsum(count) + count, count) + np.arange(len(hit))
                owner = items[piece]
                edits = np.array(self.edits, dtype=np.int64)[owner]
                starts = np.maximum(begins[block[hit]], block[hit] - places[piece] - edits)
                order = np.lexsort((starts, owner))
                owner, starts = owner[order], starts[order]
                cuts = np.nonzero(np.diff(owner, prepend=-1))[0]
                for item, where in zip(owner[cuts], np.split(starts, cuts[1:])):
                    yield int(item), np.unique(where)

    def _exact(self, text: np.ndarray, limits: np.ndarray, starts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Those ``starts`` at which all ``words`` stand."""
        starts = starts[starts + len(words) <= limits[starts]]
        for k, word in enumerate(words):
            starts = starts[text[starts + k] == word]
        return starts

    def _candidates(self, text: np.ndarray, limits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """``(item, window starts)`` that share a hash key; ``limits`` has the end of each
        position's document."""
        def holding(starts: np.ndarray, reach: int, members: np.ndarray, needed: int) -> np.ndarray:
            count = np.concatenate(([0], np.cumsum(members[text], dtype=np.int32)))
            return starts[count[np.minimum(starts + reach, limits[starts])] - count[starts] >= needed]

        place = np.arange(len(text))
        for shape in self.classes:
            starts = holding(place, shape.reach, shape.rare, shape.needed_rare)
            if len(starts):
                starts = holding(starts, shape.reach, shape.words, shape.needed)
            found: dict[int, list[np.ndarray]] = {}
            for at in range(0, len(starts), WINDOW_BLOCK):
                block = starts[at : at + WINDOW_BLOCK]
                for walk, tables in enumerate(shape.walks):
                    deep = max(int(steps[-1]) for steps, _, _ in tables) + 1
                    emitted = self._walk(text, block, limits[block], deep, walk)
                    for steps, keys, items in tables:
                        key = self._keys(emitted[steps])
                        low = np.searchsorted(keys, key)
                        high = np.searchsorted(keys, key, side="right")
                        for k in range(int((high - low).max(initial=0))):
                            hit = np.nonzero(low + k < high)[0]
                            owner = items[low[hit] + k]
                            for item in np.unique(owner):
                                found.setdefault(int(item), []).append(block[hit[owner == item]])
            for item, where in found.items():
                yield item, np.unique(np.concatenate(where))

    def _shared(
        self, text: np.ndarray, limits: np.ndarray, starts: np.ndarray, own: np.ndarray, item: int, reach: int
    ) -> np.ndarray:
        """Which windows hold enough words of the item to be within its allowed edits."""
        size, edits = len(self.items[item]), self.edits[item]
        enough = np.zeros(len(starts), dtype=bool)
        for at in range(0, len(starts), WINDOW_BLOCK // 16):
            part = slice(at, at + WINDOW_BLOCK // 16)
            window = np.minimum(starts[part, None] + np.arange(reach), limits[part, None])
            enough[part] = own[text[window]].sum(axis=1) >= size - edits
        return enough

    def _all_candidates(
        self, text: np.ndarray, begins: np.ndarray, limits: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, int]]:
        """``(item, starts, words that a passage may reach beyond the item's number)``."""
        for item, starts in self._candidates(text, limits):
            yield item, starts, self.edits[item]
        for item, starts in self._piece_starts(text, begins):
            yield item, starts, 2 * self.edits[item]

    def matches(self, texts: list[bytes | None]) -> list[tuple[int, int, int, int]]:
        """``(text number, item, edit distance, end word)`` of each item that a text contains."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        encoded = [self.encode(t) for t in texts]
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(encoded[last]) <= JOINED_WORDS):
                size += len(encoded[last])
                last += 1
            text, begins, ends = self._joined(encoded[first:last])
            owner = np.repeat(np.arange(last - first), ends - begins + 1)
            limits = ends[owner]
            for item, starts, slack in self._all_candidates(text, begins[owner], limits):
                words, edits = self.items[item], self.edits[item]
                if not edits:
                    starts = self._exact(text, limits, starts, words)
                    for doc, at in zip(*np.unique(owner[starts], return_index=True)):
                        end = int(starts[at]) + len(words) - int(begins[doc])
                        best.setdefault((first + int(doc), item), (0, end))
                    continue
                own = np.zeros(self.pad + 1, dtype=bool)
                own[words] = True
                done = -1
                for start in starts[self._shared(text, limits[starts], starts, own, item, len(words) + slack)]:
                    if start < done:
                        continue
                    # One region holds this window and those that start within its length.
                    doc = owner[start]
                    done = min(int(start) + len(words), int(ends[doc]))
                    begin = max(int(begins[doc]), int(start) - edits)
                    end = min(int(ends[doc]), int(start) + 2 * (len(words) + edits))
                    distance, at = passage_distance(words, text[begin:end])
                    key = first + int(doc), item
                    if distance <= edits and distance < best.get(key, (edits + 1, 0))[0]:
                        best[key] = distance, begin - int(begins[doc]) + at
            first = last
        return [(*key, *value) for key, value in best.items()]


def _slices(benchmark: DataFrame, item_col: str, text_col: str, slice_bytes: int) -> Iterator[tuple[list, list]]:
    """Item ids and texts, in slices of about ``slice_bytes``; each is collected on its own."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    items = items.where(F.length(F.trim("text")) > 0).dropDuplicates()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // slice_bytes)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        rows.sort(key=lambda r: (str(r.item_id), r.text))
        yield [r.item_id for r in rows], [r.text.encode() for r in rows]


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = 0.8,
    recall: float = 0.97,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``(doc_id, item_id, distance, item_words, end_word)``: one row per document and item in it.

    ``distance`` is the least found edit distance in words and ``end_word`` where that passage
    ends. Rows with the same id count as one document.
    """
    spark = ready(docs.sparkSession)
    out = spark.createDataFrame([], "doc_id long, item_id long, distance int, item_words int, end_word int")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    for ids, texts in _slices(benchmark, item_col, item_text_col, slice_bytes):
        shared = spark.sparkContext.broadcast(Index(texts, similarity, recall))

        def run(batch: pa.RecordBatch, shared=shared, ids=ids) -> dict:
            index = shared.value
            docs = batch.column(0).to_pylist()
            rows = [
                (docs[doc], ids[item], distance, len(index.items[item]), end)
                for doc, item, distance, end in index.matches(utf8(batch.column(1)))
            ]
            names = ("doc_id", "item_id", "distance", "item_words", "end_word")
            return dict(zip(names, map(list, zip(*rows)))) if rows else {name: [] for name in names}

        out = out.union(map_arrow(slim, run, "doc_id long, item_id long, distance int, item_words int, end_word int"))
    best = F.min(F.struct("distance", "end_word", "item_words")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.distance", "best.item_words", "best.end_word"
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = 0.8,
    recall: float = 0.97,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``docs`` without those that contain an item; rows are filtered in place, none is shuffled."""
    spark = ready(docs.sparkSession)
    at = docs.columns.index(text_col)
    for _, texts in _slices(benchmark, item_col, item_text_col, slice_bytes):
        shared = spark.sparkContext.broadcast(Index(texts, similarity, recall))
        docs = docs.mapInArrow(frugal(_filter(shared, at)), docs.schema)
    return docs


def _filter(shared, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[[doc for doc, *_ in index.matches(utf8(batch.column(at)))]] = False
            yield batch.filter(pa.array(clean))

    return run
