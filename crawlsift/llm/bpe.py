"""Byte-level BPE: exact encoding through a trie of distinct words, and decoding.

Texts are cut into words as the vocabulary's library does. A task takes the distinct words of its
next texts that it has not met yet and walks their trie depth first (in sorted order, so only the
path to the current word is held). Every node of the path keeps one state: the last token of the
encoding of its prefix. A new node finds its state from shorter prefixes: of the tokens that end
there, longest first, it is the one that may follow the last token of what comes before it. So a
prefix that many words share is encoded once, and a word's ids are read off backwards.

Two tokens may stand side by side when no merge would have joined them earlier: of their borders'
histories (a token's right-hand parts, the other's left-hand parts, each with the merge that makes
it and the one that uses it up) no pair that exists at one time has a merge. Tokens that their own
bytes do not lead to are never used.

Nothing is shuffled: a task reads its rows, and its memory is bounded by ``GROUP_CHARS`` of text,
twice ``KNOWN_WORDS`` remembered words and the ids of one Arrow batch.

Rows: null and empty texts have no ids. Very long texts and words (a million blanks) are encoded
whole. Rows with null or repeated ids are encoded each. An empty table gives an empty table. Other
columns are ignored; decoding keeps them. Decoding skips ids that the vocabulary lacks, and bytes
that are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

import itertools
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsift.functions.subwords import join_pieces
from crawlsift.llm.common import frugal, map_arrow, ready

# Fixed values.
#: How the byte-level vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Blocks whose characters have had the same classes in all versions of Unicode in use (Latin,
#: Greek, Cyrillic, general punctuation, kana, common Han, Hangul). Others are split by the library.
SETTLED = "\\x00-\\u052f\\u1e00-\\u1eff\\u2000-\\u2064\\u3041-\\u3096\\u30a1-\\u30fa\\u4e00-\\u9fa5\\uac00-\\ud7a3"
GROUP_CHARS = 1 << 21
KNOWN_WORDS = 200_000
KNOWN_PAIRS = 1 << 20
_PIECE_WORDS = 1 << 16


def latin_pattern() -> re.Pattern:
    """``PATTERN`` for texts of the first 256 characters alone, whose classes are written out: the
    standard library's matcher reads these faster."""
    classes = {"L": "", "N": "", "s": ""}
    for c in map(chr, range(256)):
        for name, rule in (("L", r"\p{L}"), ("N", r"\p{N}"), ("s", r"\s")):
            if regex.match(rule, c):
                classes[name] += re.escape(c)
    written = PATTERN.replace(r"(?!\S)", f"(?![^{classes['s']}])").replace(r"[^\s\p{L}\p{N}]", f"[^{''.join(classes.values())}]")
    for rule, name in ((r"\p{L}", "L"), (r"\p{N}", "N"), (r"\s", "s")):
        written = written.replace(rule, f"[{classes[name]}]")
    return re.compile(written)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, and the byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens and merges of a byte-level vocabulary file, as tables; no larger than the file says.

    ``special=False`` takes special tokens in a text for plain text.
    """

    def __init__(self, path: str, special: bool = True):
        with open(path, "rb") as file:
            self.file = file.read()
        data = json.loads(self.file)
        model, splitter = data["model"], data["pre_tokenizer"]
        if (
            model["type"] != "BPE"
            or data["normalizer"]
            or splitter != splitter | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
            or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "end_of_word_suffix"))
        ):
            raise ValueError("not a plain byte-level vocabulary")
        added = data.get("added_tokens", [])
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must be plain strings")
        letters = byte_letters()
        names = dict(model["vocab"])
        self.pieces = {i: bytes(letters[c] for c in name) for name, i in names.items() if all(c in letters for c in name)}
        self.special = {t["content"]: t["id"] for t in added} if special else {}
        self.added = {t["id"] for t in added}
        self.pieces |= {t["id"]: t["content"].encode() for t in added}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._learn_merges([(names[a], names[b], names[a + b]) for a, b in merges])
        single = {i for name, i in names.items() if len(name) == 1}
        if len(single) < 256:
            raise ValueError("not a plain byte-level vocabulary: some bytes have no token")
        self._grow(single)

    def _learn_merges(self, merges: list[tuple[int, int, int]]) -> None:
        """Rank of each merge, and of each token the merge that makes it."""
        self.rank = {(a, b): n for n, (a, b, _) in enumerate(merges)}
        self.parts = {t: (a, b, n) for n, (a, b, t) in enumerate(merges)}
        if len(self.parts) < len(merges):
            raise ValueError("a token has several merges")
        for a, b, n in self.parts.values():
            if max(self.parts.get(a, (0, 0, -1))[2], self.parts.get(b, (0, 0, -1))[2]) > n:
                raise ValueError("merges are not in the order in which their parts appear")

    def by_rank(self) -> bool:
        """True when ids rise with the merges, so that an id says which of two merges comes first."""
        made = list(self.parts)
        return made == sorted(made)

    def border(self, left: int, right: int) -> int | None:
        """Rank of the first merge across the border of two tokens; None: they may be neighbours.

        Goes back through the parts that stood at the border, undoing the latest merge of either
        side. A pair can only have met between the later of their makings and the earlier of
        their ends. Of equal merges the leftmost comes first: one inside the left token goes
        before one across, one inside the right token after it.
        """
        rank, parts = self.rank, self.parts
        first = None
        left_end = right_end = len(rank)
        while True:
            n = rank.get((left, right))
            if n is not None and n < left_end and n <= right_end:
                first = n
            made_left, made_right = parts.get(left), parts.get(right)
            if made_right is not None and (made_left is None or made_right[2] >= made_left[2]):
                right, _, right_end = made_right
            elif made_left is not None:
                _, left, left_end = made_left
            else:
                return first

    def _grow(self, single: set[int]) -> None:
        """Suffix automaton of the usable tokens: per node and byte the next node, per node the
        longest token that ends there, per token the next shorter one."""
        usable = set(single)
        for token, (a, b, n) in self.parts.items():  # in the order of merges
            if a in usable and b in usable and self.border(a, b) == n:
                usable.add(token)
        self.usable = {self.pieces[t]: t for t in usable}
        step: dict[int, int] = {}
        ends = [-1]
        for piece, token in self.usable.items():
            node = 0
            for byte in piece:
                key = node << 8 | byte
                node = step.get(key) or step.setdefault(key, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = token
        back = [0] * len(ends)
        self.longest = list(ends)
        self.shorter: dict[int, int] = {}
        by_node: dict[int, list[tuple[int, int]]] = {}
        for key, node in step.items():
            by_node.setdefault(key >> 8, []).append((key & 255, node))
        level = [0]
        while level:
            deeper = []
            for node in level:
                for byte, child in by_node.get(node, ()):
                    deeper.append(child)
                    at = back[node]
                    while node and at and (at << 8 | byte) not in step:
                        at = back[at]
                    back[child] = step.get(at << 8 | byte, 0) if node else 0
                    shorter = self.longest[back[child]]
                    if ends[child] < 0:
                        self.longest[child] = shorter
                    else:
                        self.shorter[ends[child]] = shorter
            level = deeper
        self.step, self.back = step, back


class Encoder:
    """Encodes words through their trie; lives in a task."""

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.vocabulary = vocabulary
        self.split = regex.compile(PATTERN)
        self.latin = latin_pattern()
        self.beyond_latin = re.compile("[^\\x00-\\xff]")
        self.unsettled = regex.compile(f"[^{SETTLED}]")
        self.library = Tokenizer.from_str(vocabulary.file.decode()).pre_tokenizer
        names = sorted(vocabulary.special, key=lambda s: (-len(s), s))
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.sizes = [0] * (max(vocabulary.pieces) + 1)
        for token, piece in vocabulary.pieces.items():
            self.sizes[token] = len(piece)
        #: Ids of known words, as 32-bit integers; ``older`` holds those met before the last change.
        self.known: dict[str | int, bytes] = {}
        self.older: dict[str | int, bytes] = {}
        self.fits: dict[int, bool] = {}
        self.nodes = 0

    def words(self, text: str) -> Iterator[list[str | int]]:
        """The words of a text in lists of bounded size; special tokens stand as their id."""
        for n, part in enumerate(self.special.split(text) if self.special else [text]):
            if n % 2:
                yield [self.vocabulary.special[part]]
            elif self.unsettled.search(part):
                yield [part[a:b] for _, (a, b) in self.library.pre_tokenize_str(part)]
            else:
                split = self.split if self.beyond_latin.search(part) else self.latin
                if len(part) <= GROUP_CHARS:
                    yield split.findall(part)
                    continue
                found = (m[0] for m in split.finditer(part))
                while some := list(itertools.islice(found, _PIECE_WORDS)):
                    yield some

    def walk(self, words: list[bytes]) -> Iterator[list[int]]:
        """Ids of sorted distinct words: their trie, depth first."""
        v, sizes, fits = self.vocabulary, self.sizes, self.fits
        step, back, longest, shorter = v.step.get, v.back, v.longest, v.shorter
        nodes, last = [0], [-1]
        before = b""
        for word in words:
            at, end = 0, min(len(before), len(word))
            if word[:end] == before[:end]:
                at = end
            else:
                while word[at] == before[at]:
                    at += 1
            del nodes[at + 1 :], last[at + 1 :]
            self.nodes += len(word) - at
            node = nodes[at]
            for byte in word[at:]:
                at += 1
                while (longer := step(node << 8 | byte)) is None:
                    node = back[node]
                node = longer
                token = longest[node]
                # Of the tokens that end here: the longest that may follow what comes before it.
                while start := at - sizes[token]:
                    pair = last[start] << 32 | token
                    fit = fits.get(pair)
                    if fit is None:
                        fit = fits[pair] = v.border(last[start], token) is None
                    if fit:
                        break
                    token = shorter[token]
                nodes.append(node)
                last.append(token)
            before = word
            ids = []
            while at:
                ids.append(last[at])
                at -= sizes[last[at]]
            ids.reverse()
            yield ids
            if len(fits) > KNOWN_PAIRS:
                fits.clear()

    def learn(self, words: set[str | int]) -> None:
        """Make the ids of ``words`` known. When many are, those not met again lately are forgotten."""
        if len(self.known) > KNOWN_WORDS:
            self.known, self.older = {}, self.known
        usable = self.vocabulary.usable
        todo = []
        for word in words.difference(self.known):
            if (ids := self.older.get(word)) is not None:
                self.known[word] = ids
            elif isinstance(word, int):
                self.known[word] = array("i", [word]).tobytes()
            elif (token := usable.get(data := word.encode("utf-8"))) is not None:
                self.known[word] = array("i", [token]).tobytes()
            else:
                todo.append((data, word))
        todo.sort()
        for (_, word), ids in zip(todo, self.walk([data for data, _ in todo])):
            self.known[word] = array("i", ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text; null has none."""
        return [np.frombuffer(ids, dtype=np.int32) for ids in self.encode_bytes(texts)]

    def encode_bytes(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as 32-bit integers. Words are learnt for ``GROUP_CHARS`` of text at a
        time."""
        found: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str | int]]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            self.learn(set(itertools.chain.from_iterable(words for _, words in held)))
            for row, words in held:
                found[row].append(b"".join(map(self.known.__getitem__, words)))
            held.clear()
            size = 0

        for row, text in enumerate(texts):
            if text:
                for words in self.words(text):
                    held.append((row, words))
                    size += min(len(text), 8 * len(words))
                    if size >= GROUP_CHARS:
                        flush()
        flush()
        return [parts[0] if len(parts) == 1 else b"".join(parts) for parts in found]

    def encode_row(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after another, and how many each has. No word may reach from one text
        into the next when they stand side by side; then they are cut into words in one go."""
        words = list(itertools.chain.from_iterable(self.words("".join(texts))))
        self.learn(set(words))
        ids = list(map(self.known.__getitem__, words))
        # Where each text ends, in characters; the word that ends there is its last one.
        word_ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        text_ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
        last = np.searchsorted(word_ends, text_ends)
        if len(texts) and (word_ends[last] != text_ends).any():
            raise ValueError("a word reaches from one text into the next")
        counts = np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))) // 4
        return np.frombuffer(b"".join(ids), dtype=np.int32), np.diff(counts[last], prepend=0)


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` of every row."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(vocabulary)  # as large as its file, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            found = encoder.encode(batch.column(1).to_pylist())
            ends = np.cumsum([0] + [len(f) for f in found]).astype(np.int32)
            values = np.concatenate(found) if found else np.empty(0, dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(frugal(run), "doc_id long, ids array<int>")


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the text of their ids as column ``out``; null ids give a null text."""
    spark = ready(rows.sparkSession)
    if out in rows.columns:
        raise ValueError(f"there is a column {out} already")
    table = [vocabulary.pieces.get(i, b"") for i in range(max(vocabulary.pieces) + 1)]
    shared = spark.sparkContext.broadcast([*table, b""])  # the last is for ids that there are none of
    kept = {f.name: f.dataType for f in rows.schema}

    def run(batch: pa.RecordBatch) -> dict:
        column = batch.column(batch.schema.get_field_index(ids_col))
        return dict(zip(batch.schema.names, batch.columns)) | {out: join_pieces(column, shared.value)}

    fields = ", ".join(f"`{name}` {kind.simpleString()}" for name, kind in kept.items())
    return map_arrow(rows, run, f"{fields}, `{out}` string")


def digests(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every text encoded, and decoded again."""
    back = decode(encode(docs, vocabulary, id_col, text_col), vocabulary)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
