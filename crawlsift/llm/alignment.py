"""Alignment of two tokenizers over the same texts, with counts of linked ids.

Every text is encoded by both; the bytes of the tokens of either side, joined, are a blank and the
text. Byte offsets where tokens of both sides end cut them into groups. The two tokens that end
there together are linked, and a pair of ids counts as often as it is linked in all documents.
Neither side has a token across a blank that follows other characters, so a text is aligned part by
part between such blanks, and a task aligns equal parts once.

First pass: every task aligns its documents and sums the pairs it meets; the distinct pairs get a
minimal perfect hash, every task's sums become a dense vector indexed by it, and vectors are added
as a tree. Second pass: documents are aligned again and look their pairs up; the key kept for each
number proves that the number is the pair's own.

Of two tokens that end together one is the end of the other, so the vocabularies alone bound the
distinct pairs (``Tokenizers.pairs``), whatever the data: that bounds what a task holds, what
comes to the driver and what is broadcast.

Rows: a text that is null or empty, or whose tokens' bytes are not a blank and the text, has no
tokens: zeros and empty groups. Very long texts are encoded whole. Rows with null or repeated ids
are aligned and counted each. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsift.llm import perfect_hash
from crawlsift.llm.bpe import PATTERN, Encoder, Vocabulary
from crawlsift.llm.common import frugal, ready
from crawlsift.session import BROADCAST_LIMIT_BYTES, materialize

# Fixed values.
_BLANK_PIECE = "▁"
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
GROUP_CHARS = 1 << 22
#: Distinct parts that a task remembers.
KNOWN_PARTS = 500_000
#: A cut between parts: a blank that follows another character and has one behind it.
_CUT = re.compile(r"(?<=\S) (?=.)", re.S)
#: White space that the rank encoder's pattern may not have the stack for.
_LONG_BLANK = re.compile(r"\s{10000}")
#: Blanks that are no cut: beside white space, or at either end.
_NO_CUT = re.compile(r"\s |^ | $")
#: Key, count and mark of a pair, and its bits in the hash.
_PAIR_BYTES = 32


class Tokenizers:
    """A byte-level vocabulary (A) and a piece model (B) that puts a blank before a text."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece

        self.a = Vocabulary(byte_level, special=False)
        with open(pieces, "rb") as file:
            self.model = file.read()
        b = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        names = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.a_pieces = self.a.pieces
        self.b_pieces = [
            bytes([int(m[1], 16)]) if b.is_byte(i) and (m := _BYTE_PIECE.fullmatch(name)) else name.replace(_BLANK_PIECE, " ").encode()
            for i, name in enumerate(names)
        ]
        if any(_BLANK_PIECE in name.lstrip(_BLANK_PIECE) for name in names):
            raise ValueError("the piece model has tokens across a blank")
        self.pairs = self._bound()
        if self.pairs * _PAIR_BYTES > BROADCAST_LIMIT_BYTES:
            raise ValueError(f"vocabularies with up to {self.pairs} pairs are too large to broadcast their counts")

    def _bound(self) -> int:
        """How many pairs of ids can end together: one's bytes are the end of the other's."""
        a, b = Counter(self.a_pieces.values()), Counter(self.b_pieces)

        def ends(left: Counter, right: Counter, at: int) -> int:
            return sum(n * right[piece[i:]] for piece, n in left.items() for i in range(at, len(piece)))

        return ends(a, b, 0) + ends(b, a, 1)


def _sizes(pieces: dict[int, bytes]) -> np.ndarray:
    sizes = np.zeros(max(pieces) + 1, dtype=np.int64)
    for i, piece in pieces.items():
        sizes[i] = len(piece)
    return sizes


@dataclass
class Aligned:
    """Tokens of some parts one after another, and the places of the tokens that end together."""

    n_a: np.ndarray
    n_b: np.ndarray
    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray

    def pairs(self) -> np.ndarray:
        return self.a[self.cut_a].astype(np.int64) << 32 | self.b[self.cut_b].astype(np.int64)

    def followed_by(self, other: "Aligned") -> "Aligned":
        at_a, at_b = len(self.a), len(self.b)
        pairs = [(self.n_a, other.n_a), (self.n_b, other.n_b), (self.a, other.a), (self.b, other.b)]
        cuts = [(self.cut_a, other.cut_a + at_a), (self.cut_b, other.cut_b + at_b)]
        return Aligned(*map(np.concatenate, pairs + cuts))

    def rows(self) -> np.ndarray:
        """The part that each link belongs to."""
        return np.searchsorted(np.cumsum(self.n_a), self.cut_a, side="right")


@dataclass
class LinkCounts:
    """Corpus counts of linked pairs: by the perfect hash, the pair, its count, whether it is a
    most frequent one of its B id."""

    hashed: perfect_hash.PerfectHash
    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray

    def look_up(self, pairs: np.ndarray) -> np.ndarray:
        """Numbers of the pairs, each verified by its key."""
        numbers = self.hashed.numbers(pairs)
        if len(pairs) and ((numbers < 0).any() or (self.keys[numbers] != pairs).any()):
            raise ValueError("a linked pair was not counted: the documents changed between the passes")
        return numbers


class Aligner:
    """Aligns texts; lives in a task. With ``counts`` it also looks every link up."""

    #: Columns of what is known of a part.
    N_A, N_B, N_LINKS, N_BEST, COUNT_SUM = range(5)

    def __init__(self, tokenizers: Tokenizers, counts: LinkCounts | None = None):
        import sentencepiece
        import tiktoken

        self.t = tokenizers
        self.counts = counts
        self.encoder = Encoder(tokenizers.a)
        self.ranks = None
        if tokenizers.a.by_rank():
            pieces = {tokenizers.a.pieces[t]: t for t in tokenizers.a_pieces if t not in tokenizers.a.added}
            self.ranks = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=pieces, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_proto=tokenizers.model)
        self.a_sizes = _sizes(tokenizers.a_pieces)
        self.b_sizes = _sizes(dict(enumerate(tokenizers.b_pieces)))
        seps = ";", ",", "|"  # a group's first token, further tokens, the first one of B
        self.width = max(len(self.a_sizes), len(self.b_sizes))
        self.names = [sep + str(i) for sep in seps for i in range(self.width)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.facts = np.zeros((0, 5), dtype=np.int64)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.shown: list[str] = []

    def a_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A of texts that split apart at their borders, and how many each has.

        The rank encoder reads all of them in one go; it gets the vocabulary's own ranks. Texts with
        characters that it may class otherwise, or with white space that it cannot walk, go through
        the vocabulary's trie.
        """
        joined = "".join(texts)
        if self.ranks is None or self.encoder.unsettled.search(joined) or _LONG_BLANK.search(joined):
            return self.encoder.encode_row(texts)
        ids = np.array(self.ranks.encode_ordinary(joined), dtype=np.int32)
        sizes = map(len, texts) if joined.isascii() else (len(text.encode()) for text in texts)
        ends = np.cumsum(np.fromiter(sizes, dtype=np.int64, count=len(texts)))
        last = np.searchsorted(np.cumsum(self.a_sizes[ids]), ends)
        return ids, np.diff(last + 1, prepend=0)

    def align(self, parts: list[str]) -> Aligned:
        """Tokens of parts, each with a blank before it; a part has none whose tokens' bytes differ."""
        texts = [" " + part for part in parts]
        a, n_a = self.a_ids(texts)
        b_ids = self.model.encode(parts, num_threads=1)
        n_b = np.fromiter(map(len, b_ids), dtype=np.int64, count=len(parts))
        b = np.fromiter(chain.from_iterable(b_ids), dtype=np.int32, count=int(n_b.sum()))
        a_piece, b_piece = self.t.a_pieces.__getitem__, self.t.b_pieces.__getitem__
        a_bytes, b_bytes = list(map(a_piece, a.tolist())), list(map(b_piece, b.tolist()))
        if not b"".join(a_bytes) == b"".join(b_bytes) == "".join(texts).encode():
            good = np.ones(len(parts), dtype=bool)
            for i, (text, x, y) in enumerate(zip(texts, np.cumsum(n_a), np.cumsum(n_b))):
                good[i] = b"".join(a_bytes[x - n_a[i] : x]) == b"".join(b_bytes[y - n_b[i] : y]) == text.encode()
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        at = np.searchsorted(b_end, a_end)  # both sides of a part have the same bytes in all
        cut_a = np.nonzero(b_end[np.minimum(at, len(b_end) - 1)] == a_end)[0] if len(b_end) else np.empty(0, dtype=np.int64)
        return Aligned(n_a, n_b, a, b, cut_a, at[cut_a])

    def group_texts(self, found: Aligned) -> list[str]:
        """Groups of each part as ``a1,a2|b1;a3|b2,b3``."""
        group_a = np.searchsorted(found.cut_a, np.arange(len(found.a)))
        group_b = np.searchsorted(found.cut_b, np.arange(len(found.b)))
        sep_a, sep_b = np.ones(len(found.a), dtype=np.int64), np.ones(len(found.b), dtype=np.int64)
        sep_a[np.concatenate(([0], found.cut_a[:-1] + 1))[: len(found.cut_a)]] = 0
        sep_b[np.concatenate(([0], found.cut_b[:-1] + 1))[: len(found.cut_b)]] = 2
        # A group's tokens of A come before those of B: places of either side among both.
        b_before = np.concatenate(([0], found.cut_b + 1))[group_a] if len(found.a) else group_a
        a_before = np.concatenate((found.cut_a + 1, [0]))[group_b] if len(found.b) else group_b
        names = np.empty(len(found.a) + len(found.b), dtype=np.int64)
        names[np.arange(len(found.a)) + b_before] = sep_a * self.width + found.a
        names[np.arange(len(found.b)) + a_before] = sep_b * self.width + found.b
        shown = list(map(self.names.__getitem__, names.tolist()))
        ends = np.cumsum(found.n_a + found.n_b).tolist()
        return ["".join(shown[start:end])[1:] for start, end in zip([0, *ends], ends)]

    def learn(self, parts: set[str]) -> None:
        """Align the parts that are not known."""
        new = list(parts.difference(self.known))
        if not new:
            return
        # White space at the end of a text would run on into a part behind it: such parts come last.
        open_ended = [part for part in new if part[-1].isspace()]
        if open_ended:
            new = [part for part in new if not part[-1].isspace()] + open_ended
        found = self.align(new[: len(new) - len(open_ended)])
        for part in open_ended:
            found = found.followed_by(self.align([part]))
        row = found.rows()
        facts = np.zeros((len(new), 5), dtype=np.int64)
        facts[:, self.N_A], facts[:, self.N_B] = found.n_a, found.n_b
        facts[:, self.N_LINKS] = np.bincount(row, minlength=len(new))
        pairs = found.pairs()
        if self.counts is None:
            self.pairs = np.concatenate((self.pairs, pairs))
        else:
            numbers = self.counts.look_up(pairs)
            facts[:, self.N_BEST] = np.bincount(row[self.counts.best[numbers]], minlength=len(new))
            np.add.at(facts[:, self.COUNT_SUM], row, self.counts.counts[numbers])
            self.shown += self.group_texts(found)
        self.known.update(zip(new, range(len(self.facts), len(self.facts) + len(new))))
        self.facts = np.concatenate((self.facts, facts))

    def groups(self, texts: Iterator[str | None]) -> Iterator[list[tuple[int, list[str]]]]:
        """Parts of the texts by number, for about ``GROUP_CHARS`` of text at a time."""
        held: list[tuple[int, list[str]]] = []
        size = 0
        for number, text in enumerate(texts):
            at = 0
            while text and at < len(text):
                end = len(text)
                if end - at > GROUP_CHARS and (cut := _CUT.search(text, at + GROUP_CHARS)):
                    end = cut.start()
                piece = text[at:end] if (at, end) != (0, len(text)) else text
                held.append((number, piece.split(" ") if _NO_CUT.search(piece) is None else _CUT.split(piece)))
                size += end - at
                at = end + 1  # the blank belongs to what follows
                if size >= GROUP_CHARS:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def places(self, group: list[tuple[int, list[str]]]) -> np.ndarray:
        """Numbers of the known parts of a group, which are learnt if need be."""
        parts = set(chain.from_iterable(p for _, p in group))
        if len(self.known) + len(parts) > KNOWN_PARTS:
            self.forget()
        self.learn(parts)
        n = sum(len(p) for _, p in group)
        return np.fromiter(map(self.known.__getitem__, chain.from_iterable(p for _, p in group)), dtype=np.int64, count=n)

    def totals(self, group: list[tuple[int, list[str]]], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the facts of each entry of a group, and whether one of its parts has no tokens."""
        starts = np.cumsum([0] + [len(p) for _, p in group])[:-1]
        facts = self.facts[places]
        return np.add.reduceat(facts, starts), np.logical_or.reduceat(facts[:, self.N_A] == 0, starts)


def _bad_texts(aligner: Aligner, texts: list[str | None]) -> set[int]:
    """Numbers of the texts of which a part has no tokens: then all of the text has none."""
    bad: set[int] = set()
    for group in aligner.groups(iter(texts)):
        _, wrong = aligner.totals(group, aligner.places(group))
        bad.update(number for (number, _), w in zip(group, wrong) if w)
    return bad


def pair_counts(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """``(pair, n)``: how often each task linked a pair of ids, ``a << 32 | b``."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(shared.value)
        pairs, counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        times = np.zeros(0, dtype=np.int64)  # of each known part

        def settle() -> None:
            """Add what the known parts have linked to the counts."""
            nonlocal pairs, counts, times
            links = np.repeat(times, aligner.facts[: len(times), Aligner.N_LINKS])
            both, place = np.unique(np.concatenate((pairs, aligner.pairs[: len(links)])), return_inverse=True)
            total = np.zeros(len(both), dtype=np.int64)
            np.add.at(total, place, np.concatenate((counts, links)))
            pairs, counts, times = both, total, times[:0]

        forget = aligner.forget

        def settle_and_forget() -> None:
            settle()
            forget()

        aligner.forget = settle_and_forget
        for batch in batches:
            for texts in _some_texts(batch.column(1)):
                bad: set[int] | None = None
                for group in aligner.groups(iter(texts)):
                    places = aligner.places(group)
                    if bad is None:  # only texts with parts that have no tokens are looked at twice
                        _, wrong = aligner.totals(group, places)
                        long = sum(map(len, filter(None, texts))) > GROUP_CHARS
                        if wrong.any() or long:
                            bad = _bad_texts(aligner, texts)
                            places = aligner.places(group)
                    if bad:
                        keep = np.repeat([number not in bad for number, _ in group], [len(p) for _, p in group])
                        places = places[keep]
                    found = np.bincount(places, minlength=len(aligner.facts))
                    found[: len(times)] += times
                    times = found
        settle()
        for at in range(0, len(pairs), 1 << 16):
            yield pa.RecordBatch.from_pydict({"pair": pairs[at : at + (1 << 16)], "n": counts[at : at + (1 << 16)]})

    return docs.mapInArrow(frugal(run), "pair long, n long")


def _some_texts(column: pa.Array) -> Iterator[list[str | None]]:
    """Texts of a column, those that are one group's work at a time."""
    texts: list[str | None] = []
    size = 0
    for value in column:
        text = value.as_py()
        if texts and size + len(text or "") > GROUP_CHARS:
            yield texts
            texts, size = [], 0
        texts.append(text)
        size += len(text or "")
    if texts:
        yield texts


def count_links(docs: DataFrame, tokenizers: Tokenizers) -> LinkCounts:
    """First pass: the counts of all linked pairs of ids of ``(doc_id, text)`` rows."""
    chunk = 8192
    counted = materialize(pair_counts(docs, tokenizers), "pair-counts")
    distinct = materialize(counted.select("pair").distinct(), "pairs")
    hashed = perfect_hash.build(distinct, "pair", tokenizers.pairs)
    n = len(hashed)
    if n > tokenizers.pairs:
        raise ValueError("more pairs than the vocabularies allow")
    keys, counts = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    # Both are bounded by the vocabularies.
    found = distinct.toArrow().column("pair").to_numpy()
    keys[hashed.numbers(found)] = found
    if n:
        for row in perfect_hash.dense_sums(counted, "pair", "n", hashed, chunk=chunk).collect():
            counts[row.chunk * chunk : (row.chunk + 1) * chunk] = np.frombuffer(row.sums, dtype=np.int64)
    most = np.zeros(len(tokenizers.b_pieces), dtype=np.int64)
    b = keys & 0xFFFFFFFF
    np.maximum.at(most, b, counts)
    return LinkCounts(hashed, keys, counts, counts == most[b])


def align(docs: DataFrame, tokenizers: Tokenizers, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` of every row.

    ``groups`` shows the ids of each group, ``a1,a2|b1;a3|b2,b3``. ``n_best`` counts the links
    whose pair is linked as often as any with their B id, ``count_sum`` adds all links' counts.
    """
    spark = ready(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast((tokenizers, count_links(slim, tokenizers)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        for batch in batches:
            start = 0
            for texts in _some_texts(batch.column(1)):
                sums = np.zeros((len(texts), 5), dtype=np.int64)
                bad = np.zeros(len(texts), dtype=bool)
                shown: list[list[str]] = [[] for _ in texts]
                for group in aligner.groups(iter(texts)):
                    places = aligner.places(group)
                    total, wrong = aligner.totals(group, places)
                    numbers = places.tolist()
                    at = 0
                    for (number, parts), t, w in zip(group, total, wrong):
                        sums[number] += t
                        bad[number] |= w
                        shown[number].append(";".join([aligner.shown[i] for i in numbers[at : at + len(parts)]]))
                        at += len(parts)
                sums[bad] = 0
                texts_shown = ["" if b else ";".join(x) for b, x in zip(bad, shown)]
                columns = [sums[:, c] for c in (Aligner.N_A, Aligner.N_B, Aligner.N_LINKS, Aligner.N_LINKS, Aligner.N_BEST, Aligner.COUNT_SUM)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), *map(pa.array, columns), pa.array(texts_shown, pa.string())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
                )
                start += len(texts)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return slim.mapInArrow(frugal(run), schema)
