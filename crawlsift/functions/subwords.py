"""Subword ids: pair merges learnt from word counts, and longest-match encoding that loses nothing.

Text is cut into pieces: a word (letters and digits) with the blank before it, or one other
character. Merges are learnt inside words, from the most frequent pair of neighbouring symbols on.
The table of distinct words stays distributed; of each round only the best pairs come to the driver.
The vocabulary is the symbols that merges made, all single characters that the texts have, and the
256 bytes, so every text has ids and every list of ids has its text back.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.session import materialize

# Fixed values.
WORD = r"[ ]?[\p{L}\p{N}]+"
PIECE = WORD + r"|[^\p{L}\p{N}]"
#: Symbols of a word are wrapped, so that a pair can be told from other characters.
OPEN, CLOSE = "{", "}"
#: Vocabularies of more entries than this are refused, as they travel to the workers.
MAX_SUBWORDS = 200_000
#: Best pairs of a round that are looked at per merge wanted.
_CANDIDATES = 4
BYTE_IDS = 256
KNOWN_PIECES = 200_000
_PIECES_AT_A_TIME = 1 << 16

ENCODED = T.StructType(
    [
        T.StructField("input_ids", T.ArrayType(T.IntegerType())),
        T.StructField("attention_mask", T.ArrayType(T.IntegerType())),
    ]
)


def word_symbols(df: DataFrame, text: str) -> DataFrame:
    """``(symbols, n)``: every distinct word as wrapped characters, and how often it occurs."""
    words = df.select(F.explode(F.regexp_extract_all(text, F.lit(WORD), 0)).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.regexp_replace("word", "(?s)(.)", r"\{$1\}").alias("symbols"), "n")


def pair_counts(words: DataFrame) -> DataFrame:
    """``(left, right, n)``: how often two symbols stand side by side in all words."""
    split = words.select(F.regexp_extract_all("symbols", F.lit(r"\{([^}]*)\}"), 1).alias("s"), "n")
    sides = F.arrays_zip(
        F.slice("s", F.lit(1), F.size("s") - 1).alias("left"), F.slice("s", F.lit(2), F.size("s") - 1).alias("right")
    )
    pairs = split.where(F.size("s") > 1).select(F.inline(sides), "n")
    return pairs.groupBy("left", "right").agg(F.sum("n").alias("n"))


def _independent(pairs: list[tuple[str, str, int]], wanted: int) -> list[tuple[str, str, int]]:
    """The first pairs of which none has a symbol of an earlier one, so that merging one does not
    change the count of another."""
    taken: set[str] = set()
    out = []
    for left, right, n in pairs:
        if taken.isdisjoint((left, right)):
            out.append((left, right, n))
            taken |= {left, right}
            if len(out) == wanted:
                break
    return out


def learn_merges(df: DataFrame, text: str, n_merges: int, per_round: int = 32, least: int = 2) -> list[tuple[str, str, int]]:
    """Up to ``n_merges`` merges ``(left, right, n)``, in the order in which they are made.

    A round counts all pairs and makes the ``per_round`` most frequent ones that share no symbol
    (1 makes one at a time, as the classical method does); ties go by the symbols. Pairs that occur
    fewer than ``least`` times are not merged. Null and empty texts have no words.
    """
    if not 0 <= n_merges <= MAX_SUBWORDS:
        raise ValueError(f"between 0 and {MAX_SUBWORDS} merges")
    words = materialize(word_symbols(df, text), "words")
    merges: list[tuple[str, str, int]] = []
    while len(merges) < n_merges:
        wanted = min(per_round, n_merges - len(merges))
        best = (
            pair_counts(words)
            .where(F.col("n") >= least)
            .orderBy(F.desc("n"), "left", "right")
            .limit(_CANDIDATES * wanted)
        )
        chosen = _independent([tuple(r) for r in best.collect()], wanted)
        if not chosen:
            break
        merges += chosen
        merged = F.col("symbols")
        for left, right, _ in chosen:
            apart = f"{OPEN}{left}{CLOSE}{OPEN}{right}{CLOSE}"
            merged = F.replace(merged, F.lit(apart), F.lit(f"{OPEN}{left}{right}{CLOSE}"))
        if len(merges) < n_merges:
            words = materialize(words.select(merged.alias("symbols"), "n"), "words")
    return merges


def subword_vocabulary(df: DataFrame, text: str, n_merges: int, per_round: int = 32) -> list[str]:
    """Subwords by id, from ``BYTE_IDS`` on: single characters in order, then merged symbols."""
    merges = learn_merges(df, text, n_merges, per_round)
    characters = (
        df.select(F.explode(F.array_distinct(F.split(F.coalesce(text, F.lit("")), ""))).alias("c"))
        .where("c <> ''")
        .distinct()
        .limit(MAX_SUBWORDS + 1)
    )
    singles = sorted(r.c for r in characters.collect())
    known = set(singles)
    merged = [w for w in dict.fromkeys(left + right for left, right, _ in merges) if w not in known]
    if len(singles) + len(merged) > MAX_SUBWORDS:
        raise ValueError(f"more than {MAX_SUBWORDS} subwords")
    return singles + merged


class Trie:
    """Subwords by their characters; finds the longest one that a text goes on with."""

    def __init__(self, subwords: list[str]):
        self.root: dict = {}
        for number, word in enumerate(subwords):
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = BYTE_IDS + number

    def ids(self, piece: str) -> list[int]:
        """Ids of a piece, longest match first; characters without an entry as their bytes."""
        out: list[int] = []
        at = 0
        while at < len(piece):
            node, found, end = self.root, None, at
            for place in range(at, len(piece)):
                node = node.get(piece[place])
                if node is None:
                    break
                if "" in node:
                    found, end = node[""], place + 1
            if found is None:
                out += piece[at].encode("utf-8", "replace")
                at += 1
            else:
                out.append(found)
                at = end
        return out


def subword_encoder(subwords: list[str]) -> Callable[[Column], Column]:
    """Function ``text column -> struct<input_ids, attention_mask>``, a tokenizer for the jobs.

    The vocabulary is bounded by MAX_SUBWORDS and travels with the function. Null texts have no
    ids. A worker remembers the ids of up to KNOWN_PIECES pieces.
    """
    import regex

    if len(subwords) > MAX_SUBWORDS:
        raise ValueError(f"more than {MAX_SUBWORDS} subwords")
    trie = Trie(subwords)
    pieces = regex.compile(PIECE)
    known: dict[str, bytes] = {}

    def ids_of(text: str | None) -> bytes:
        """Ids of a text as 32-bit integers."""
        out: list[bytes] = []
        found = (m[0] for m in pieces.finditer(text or ""))
        while some := list(islice(found, _PIECES_AT_A_TIME)):
            if len(known) > KNOWN_PIECES:
                known.clear()
            for piece in some:
                ids = known.get(piece)
                if ids is None:
                    ids = known[piece] = array("i", trie.ids(piece)).tobytes()
                out.append(ids)
        return b"".join(out)

    @F.arrow_udf(ENCODED)
    def encode(texts: pa.Array) -> pa.Array:
        rows = [ids_of(text.as_py()) for text in texts]
        ends = pa.array(np.cumsum([0] + [len(row) // 4 for row in rows], dtype=np.int32))
        values = np.frombuffer(b"".join(rows), dtype=np.int32)
        ids = pa.ListArray.from_arrays(ends, pa.array(values))
        mask = pa.ListArray.from_arrays(ends, pa.array(np.ones(len(values), dtype=np.int32)))
        return pa.StructArray.from_arrays([ids, mask], names=ENCODED.names)

    def tokenize(text: Column) -> Column:
        return encode(text)

    return tokenize


def join_pieces(ids: pa.Array, pieces: list[bytes]) -> pa.Array:
    """Texts of lists of ids: the pieces at these places, joined. Places beyond the last piece count
    as the last. Null lists are null; bytes that are no UTF-8 become U+FFFD."""
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    flat = pc.fill_null(ids.flatten(), -1).to_numpy(zero_copy_only=False)
    at = np.where((flat < 0) | (flat >= len(pieces)), len(pieces) - 1, flat)
    found = pa.array(pieces, pa.large_binary()).take(pa.array(at))
    places = np.frombuffer(found.buffers()[1], dtype=np.int64, count=len(found) + 1) if len(found) else np.zeros(1, np.int64)
    ends = np.ascontiguousarray(places[np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))])
    data = found.buffers()[2] if len(found) else pa.py_buffer(b"")
    rows = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), data])
    try:
        texts = rows.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([row.as_py().decode("utf-8", "replace") for row in rows], pa.string())
    return pc.if_else(ids.is_valid(), texts, None)


def subword_decoder(subwords: list[str]) -> Callable[[Column], Column]:
    """Function ``ids column -> text column``. Ids that the vocabulary lacks are passed over; bytes
    that are no UTF-8 become U+FFFD. Null ids have a null text."""
    parts = [bytes([b]) for b in range(BYTE_IDS)] + [w.encode("utf-8") for w in subwords]
    parts.append(b"")  # of ids that there are none of

    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        return join_pieces(ids, parts)

    def detokenize(ids: Column) -> Column:
        return decode(ids)

    return detokenize


assert re.escape(OPEN + CLOSE) == r"\{\}"  # as the patterns above have them
