"""Byte-level encoding and tokenizer alignment against the libraries."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from crawlsift.llm import alignment, bpe, perfect_hash
from crawlsift.llm.queries import BYTE_LEVEL, PIECES, op11_cross_tokenizer_alignment, op13_bpe_round_trip
from tests.llm.conftest import SF

BITS = ["a", "b", "e", "t", " ", "  ", "\n", "1", "'s", "é", "的", "😀", "!", "--", "ing", " the", "\t", "　", "<|endoftext|>", "ʰ", "՘", "࢏", "\x85", "\x1c", "x"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_LEVEL)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(BYTE_LEVEL)


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(BYTE_LEVEL, PIECES)


def odd_texts(n=3000):
    rng = random.Random(1)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return texts + [" " * 100_000 + "x", "a" * 5000, "ab" * 3000, "-" * 3000, " \n" * 500, "=" * 999, "", "\0", "的" * 4000]


def test_encoder_equals_the_library(library, vocabulary):
    texts = odd_texts()
    got = bpe.Encoder(vocabulary).encode([*texts, None])
    for text, ids in zip(texts, got):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text[:80]
    assert len(got[-1]) == 0


def test_small_groups_and_forgetting(library, vocabulary, monkeypatch):
    for name, value in {"GROUP_CHARS": 50, "KNOWN_WORDS": 20, "KNOWN_PAIRS": 10, "_PIECE_WORDS": 3}.items():
        monkeypatch.setattr(bpe, name, value)
    texts = odd_texts(300)[:300]
    got = bpe.Encoder(vocabulary).encode(texts)
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_latin_texts_split_as_others(vocabulary):
    import regex

    split, latin = regex.compile(bpe.PATTERN), bpe.latin_pattern()
    rng = random.Random(2)
    singles = list(map(chr, range(256)))
    bits = [*singles, "'s", "'ll", "  ", "\n\n", "ab", "é", "12", "\x1c", "\x85", "\xa0"]
    texts = singles + [f"{a}{b}x" for a in singles for b in singles]
    texts += ["".join(rng.choice(bits) for _ in range(30)) for _ in range(3000)]
    assert [t for t in texts if split.findall(t) != latin.findall(t)] == []
    assert bpe.Encoder(vocabulary).latin.groups == 0


def test_decoding_whole_batches(spark, vocabulary):
    """Ids without a token, null lists, and characters cut between rows."""
    cut = [i for i, piece in vocabulary.pieces.items() if piece in (b"\xc3", b"\xa9")]
    both = sorted(cut, key=lambda i: vocabulary.pieces[i], reverse=True)
    rows = [(1, both), (2, both[:1]), (3, both[1:]), (4, []), (5, None), (6, [-1, 10**6, *both]), (7, [vocabulary.usable[b"a"]])]
    table = spark.createDataFrame(rows, "k int, ids array<int>").coalesce(1)
    got = {r.k: r.text for r in bpe.decode(table, vocabulary).collect()}
    assert got == {1: "é", 2: "\ufffd", 3: "\ufffd", 4: "", 5: None, 6: "é", 7: "a"}
    assert bpe.decode(table.limit(0), vocabulary).collect() == []


def test_settled_characters_split_as_in_the_library(library):
    import regex

    pattern, settled = regex.compile(bpe.PATTERN), regex.compile(f"[{bpe.SETTLED}]")
    for c in filter(settled.match, map(chr, range(0x110000))):
        text = f"a{c}1{c}!{c} {c}"
        assert [m.span() for m in pattern.finditer(text)] == [o for _, o in library.pre_tokenizer.pre_tokenize_str(text)], hex(ord(c))


def test_rank_encoder_is_the_library_on_settled_characters(library, tokenizers):
    import regex

    aligner = alignment.Aligner(tokenizers)
    settled = regex.compile(f"[{bpe.SETTLED}]")
    texts = [f" a{c}1{c}!{c} {c}x" for c in filter(settled.match, map(chr, range(0x110000)))]
    library.encode_special_tokens = True
    try:
        for at in range(0, len(texts), 5000):
            some = texts[at : at + 5000]
            ids, counts = aligner.a_ids(some)
            expected = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
            assert counts.tolist() == list(map(len, expected)) and ids.tolist() == [i for e in expected for i in e]
        odd = [" x<|endoftext|>", " ՘ ࢏a", " a" + " " * 20_000 + "b"]
        for text in odd:
            assert aligner.a_ids([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    finally:
        library.encode_special_tokens = False


def test_shared_prefixes_are_walked_once(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    words = sorted(b"qzxjqzxj" + bytes([i, j]) for i in b"abc" for j in b"xyz")
    list(encoder.walk(words))
    assert encoder.nodes == 8 + 3 + 9


def test_vocabularies_that_are_no_plain_bpe(tmp_path):
    import json

    with open(BYTE_LEVEL) as file:
        data = json.load(file)
    data["model"]["merges"] = data["model"]["merges"][::-1]
    path = tmp_path / "odd.json"
    path.write_text(json.dumps(data))
    with pytest.raises(ValueError, match="order"):
        bpe.Vocabulary(str(path))
    data["pre_tokenizer"]["add_prefix_space"] = True
    path.write_text(json.dumps(data))
    with pytest.raises(ValueError, match="plain"):
        bpe.Vocabulary(str(path))


def plain_digest(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_round_trip_query(spark, library, texts):
    rows = op13_bpe_round_trip(spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {d: plain_digest(library, t) for d, t in texts.items()}


def test_round_trip_odd_rows(spark, library, vocabulary, odd_docs, no_docs):
    got = sorted(map(repr, (tuple(r) for r in bpe.digests(odd_docs, vocabulary).collect())))
    assert got == sorted(repr((r.doc_id, *plain_digest(library, r.text))) for r in odd_docs.collect())
    empty = bpe.digests(no_docs, vocabulary)
    assert empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and empty.count() == 0


def test_decoding_odd_ids(spark, library, vocabulary):
    lists = [[], None, [50256, 87], [222], [160, 222, 88], [999_999, 88], [-1]]
    rows = spark.createDataFrame([(i, x, "kept") for i, x in enumerate(lists)], "n int, ids array<int>, note string")
    got = {r.n: r.text for r in bpe.decode(rows, vocabulary).collect()}
    for i, ids in enumerate(lists):
        assert got[i] == (None if ids is None else library.decode([x for x in ids if x >= 0], skip_special_tokens=False))
    with pytest.raises(ValueError, match="note"):
        bpe.decode(rows, vocabulary, out="note")


def plain_groups(tokenizers, library_of, text):
    """Tokens of both sides and their groups, token by token."""
    a_model, b_model = library_of
    if not text:
        return [], [], []
    a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
    data = (" " + text).encode()
    a_bytes, b_bytes = [tokenizers.a_pieces[i] for i in a], [tokenizers.b_pieces[i] for i in b]
    if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
        return [], [], []
    groups, of_a, of_b, end_a, end_b, j = [], [], [], 0, 0, 0
    for i, piece in zip(a, a_bytes):
        of_a.append(i)
        end_a += len(piece)
        while j < len(b) and end_b + len(b_bytes[j]) <= end_a:
            of_b.append(b[j])
            end_b += len(b_bytes[j])
            j += 1
        if end_a == end_b:
            groups.append((of_a, of_b))
            of_a, of_b = [], []
    return a, b, groups


def plain_alignment(tokenizers, texts):
    from collections import Counter

    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(BYTE_LEVEL)
    a_model.encode_special_tokens = True
    models = a_model, sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = [plain_groups(tokenizers, models, text) for text in texts]
    counts = Counter((a[-1], b[-1]) for _, _, groups in found for a, b in groups)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for a, b, groups in found:
        links = [(x[-1], y[-1]) for x, y in groups]
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        best = sum(counts[k] == most[k[1]] for k in links)
        out.append((len(a), len(b), len(groups), len(links), best, sum(counts[k] for k in links), shown))
    return out


def test_alignment_query(spark, tokenizers, texts):
    expected = dict(zip(texts, plain_alignment(tokenizers, texts.values())))
    rows = op11_cross_tokenizer_alignment(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        *numbers, shown = expected[r.doc_id]
        digest = hashlib.sha256(shown.encode()).hexdigest() if numbers[0] else ""
        assert tuple(r) == (r.doc_id, *numbers, digest)


def test_alignment_odd_rows(spark, tokenizers, odd_docs, no_docs):
    rows = odd_docs.collect()
    extra = ["▁x y", "<|endoftext|> <s> <0x41>", "naïve 你好😀\n\n\tx", " " * 5000 + "x", "x\0y"]
    table = odd_docs.select("doc_id", "text", "_salt").union(spark.createDataFrame([(99, t, "") for t in extra], "a long, b string, c string"))
    texts = [r.text for r in rows] + extra
    ids = [r.doc_id for r in rows] + [99] * len(extra)
    got = sorted(map(repr, (tuple(r) for r in alignment.align(table, tokenizers).collect())))
    assert got == sorted(repr((d, *x)) for d, x in zip(ids, plain_alignment(tokenizers, texts)))
    assert alignment.align(no_docs, tokenizers).count() == 0


def test_parts_and_memory(spark, tokenizers, monkeypatch):
    """Small groups and little memory: texts over several groups, parts forgotten and met again."""
    rng = random.Random(3)
    bits = ["a", "b", "the", " ", "  ", " ", "\n", "é", "的", "😀", "ing ", "\t", "word", "\x1c", "\x85", " x"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.choice([3, 40, 500]))) for _ in range(120)]
    texts += [texts[5] + "▁", "▁ " + texts[6] * 3, None, "", " ", "  ", " a ", "a ", "\n b"]
    expected = sorted(repr(x) for x in plain_alignment(tokenizers, texts))
    for chars, known in ((40, 10), (300, 10_000), (1 << 20, 60)):
        monkeypatch.setattr(alignment, "GROUP_CHARS", chars)
        monkeypatch.setattr(alignment, "KNOWN_PARTS", known)
        aligner = alignment.Aligner(tokenizers)
        table = pa.array(texts)
        pairs = {}
        for batch in _run(alignment.pair_counts, tokenizers, table):
            for pair, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pairs[pair] = pairs.get(pair, 0) + n
        assert pairs == plain_pairs(tokenizers, texts)
        assert aligner.known == {}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(repr(tuple(r)[1:]) for r in alignment.align(docs, tokenizers).collect()) == expected


def _run(operator, tokenizers, texts):
    """Batches that an operator's function of batches makes of one batch, without Spark."""

    class Frame:
        def __getattr__(self, name):
            return self

        def broadcast(self, value):
            self.value = value
            return self

        def mapInArrow(self, function, schema):
            batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc_id", "text"])
            return list(function(iter([batch])))

    return operator(Frame(), tokenizers)


def plain_pairs(tokenizers, texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(BYTE_LEVEL)
    a_model.encode_special_tokens = True
    models = a_model, sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = {}
    for text in texts:
        for a, b in plain_groups(tokenizers, models, text)[2]:
            counts[a[-1] << 32 | b[-1]] = counts.get(a[-1] << 32 | b[-1], 0) + 1
    return counts


def test_pairs_are_bounded_by_the_vocabularies(tokenizers, texts):
    found = alignment.Aligner(tokenizers).align([t for t in texts.values() if t])
    assert len(np.unique(found.pairs())) <= tokenizers.pairs
    for a, b in zip(found.a[found.cut_a][:1000], found.b[found.cut_b][:1000]):
        x, y = tokenizers.a_pieces[a], tokenizers.b_pieces[b]
        assert x.endswith(y) or y.endswith(x)


def test_changed_documents_are_noticed(tokenizers):
    keys = np.array([5, 6], dtype=np.int64)
    rows = [(0, i, len(bits), np.packbits(bits).tobytes()) for i, bits in enumerate(perfect_hash.bucket_levels(keys))]
    hashed = perfect_hash.PerfectHash.of_levels(rows, 1)
    known = np.zeros(2, dtype=np.int64)
    known[hashed.numbers(keys)] = keys
    counts = alignment.LinkCounts(hashed, known, known, known > 0)
    assert known[counts.look_up(keys)].tolist() == [5, 6]
    with pytest.raises(ValueError, match="changed"):
        counts.look_up(np.array([7], dtype=np.int64))


def test_perfect_hash_and_sums(spark):
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(-(2**62), 2**62, 5000))
    rows = [(int(k), int(n)) for k, n in zip(rng.choice(keys, 20_000), rng.integers(1, 9, 20_000))]
    table = spark.createDataFrame(rows, "k long, n long").repartition(40)
    hashed = perfect_hash.build(table, "k", 40_000)
    distinct = np.array(sorted({k for k, _ in rows}))
    numbers = hashed.numbers(distinct)
    assert len(hashed) == len(distinct) and sorted(numbers) == list(range(len(distinct)))
    sums = np.zeros(len(distinct), dtype=np.int64)
    for r in perfect_hash.dense_sums(table, "k", "n", hashed, fan_in=3, chunk=1000).collect():
        sums[r.chunk * 1000 : (r.chunk + 1) * 1000] = np.frombuffer(r.sums, dtype=np.int64)
    expected = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(expected, np.searchsorted(distinct, [k for k, _ in rows]), [n for _, n in rows])
    assert (sums[numbers] == expected).all()
    none = perfect_hash.build(table.limit(0), "k", 10)
    assert len(none) == 0 and none.numbers(distinct).tolist() == [-1] * len(distinct)
    nulls = spark.createDataFrame([(None,), (3,), (3,)], "k long")
    assert len(perfect_hash.build(nulls, "k", 10)) == 1
