"""Tokenizers, token counts and token files against the libraries."""

import hashlib
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

from tablewright.llm import bpe, tokenfiles, unigram
from tablewright.llm.queries import BYTE_BPE, PIECES, QUERIES, WORD_BPE, vocabulary


def _texts():
    rng = random.Random(11)
    any_character = [
        "".join(chr(rng.choice([rng.randint(32, 126), rng.randint(32, 0x2FFF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(50))
        for _ in range(300)
    ]
    words = ["".join(rng.choice("abcdefgaeiou'st .\n") for _ in range(70)) for _ in range(300)]
    odd = ["", " ", "\n", "a", "  two  spaces ", "a\n\n\nb \n c", "İstanbul ΣΑΣ ΌΣΟΣ", "can't 've 's'S 123 ½ ٣", "\x1ca\x1c b\x85c", "a" * 3000]
    odd += ["x<|endoftext|> y  <|endoftext|>", "<|startoftext|>z", "▁x▁▁y", "<s>a</s><unk><0x41>", "é ́e", "\x00 a\x00b"]
    return any_character + words + odd


@pytest.fixture(scope="module")
def word_library():
    return tokenizers.Tokenizer.from_file(vocabulary(WORD_BPE))


@pytest.fixture(scope="module")
def byte_library():
    return tokenizers.Tokenizer.from_file(vocabulary(BYTE_BPE))


def test_automaton_against_library(word_library):
    own = bpe.Tokenizer(bpe.read_file(vocabulary(WORD_BPE)))
    for text in _texts():
        ids = word_library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == word_library.decode(ids, skip_special_tokens=False)


def _merge_by_hand(word, merges):
    parts = list(word)
    for left, right in merges:
        i = 0
        while i < len(parts) - 1:
            if (parts[i], parts[i + 1]) == (left, right):
                parts[i : i + 2] = [left + right]
            i += 1
    return parts


def test_gadgets_against_merging():
    """Random merge lists over a small alphabet, where the same letters overlap in many ways."""
    rng = random.Random(5)
    for _ in range(150):
        labels, merges = list("ab"), []
        while len(merges) < 8:
            left, right = rng.choice(labels), rng.choice(labels)
            if left + right not in labels:
                labels.append(left + right)
                merges.append((left, right))
        try:
            own = bpe.MergeAutomaton({label: i for i, label in enumerate(labels)}, merges)
        except ValueError:  # a merge of parts that never stand side by side
            continue
        for _ in range(60):
            word = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
            assert [labels[i] for i in own.encode(word)] == _merge_by_hand(word, merges), (merges, word)


def test_walk_never_steps_back(monkeypatch):
    """One step a symbol; steps are worked out once, and beyond the kept ones the ids are the same."""
    labels, merges = ["a", "b", "ab", "aba", "abab", "ababb"], [("a", "b"), ("ab", "a"), ("ab", "ab"), ("abab", "b")]
    words = ["".join("ab"[n >> i & 1] for i in range(9)) for n in range(512)]
    own = bpe.MergeAutomaton({label: i for i, label in enumerate(labels)}, merges)
    before = own.room
    first = [own.encode(word) for word in words]
    assert 0 < before - own.room < 9 * 512
    after = own.room
    assert [own.encode(word) for word in words] == first and own.room == after
    assert [[labels[i] for i in ids] for ids in first] == [_merge_by_hand(word, merges) for word in words]
    monkeypatch.setattr(bpe, "KEPT_STEPS", 5)
    small = bpe.MergeAutomaton({label: i for i, label in enumerate(labels)}, merges)
    assert [small.encode(word) for word in words] == first
    assert small.room == 0 and len(small.states) <= 5
    assert small.encode("abbab" * 20_000) == own.encode("abbab" * 20_000)


def test_latin_words_are_taken_apart_here(word_library):
    """Letters of Latin-1 need no call of the library for each word."""
    own = bpe.Tokenizer(bpe.read_file(vocabulary(WORD_BPE)))
    library, own.normalizer, own.splitter = (own.normalizer, own.splitter), None, None
    latin = ["über Straße", "ÀÖØÞÿ", "l'été s'il", "Ñandú!!", "naïve's 3é4", "ß", "É.É"]
    for text in latin:
        assert own.encode(text) == word_library.encode(text, add_special_tokens=False).ids, text
    own.normalizer, own.splitter = library
    signs = [chr(i) for i in range(256)]
    for text in [*signs, *(f"a{sign}b{sign}{sign}É" for sign in signs), "e\u0301 é\u0301", "İß", "ΣÀΣ"]:
        assert own.encode(text) == word_library.encode(text, add_special_tokens=False).ids, repr(text)


def test_vocabulary_rules():
    with pytest.raises(ValueError, match="no earlier merge"):
        bpe.MergeAutomaton({"a": 0, "b": 1, "ab": 2, "abab": 3}, [("ab", "ab"), ("a", "b")])
    with pytest.raises(ValueError, match="not in the vocabulary"):
        bpe.MergeAutomaton({"a": 0}, []).encode("ab")


def test_encode_texts(spark, odd_docs, no_docs, word_library):
    path = vocabulary(WORD_BPE)
    clash = odd_docs.withColumn("ids", F.lit("mine")).withColumn("n_tokens", F.lit(-1))
    rows = bpe.encode_texts(clash, path, ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"), ("doc_id", "text")).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        ids = word_library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = word_library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids"], r["decoded"]) == (len(ids), ids, decoded)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_texts(no_docs, path).collect() == []


def test_bpe_query(spark, sf, word_library):
    found = {r["doc_id"]: r for r in QUERIES["op9_bpe"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = word_library.encode(r["text"] or "", add_special_tokens=False).ids
        assert found[r["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@pytest.fixture(scope="module")
def pieces():
    return unigram.pieces_of(unigram.read_file(vocabulary(PIECES)))


def _unigram_library(vocab):
    library = tokenizers.Tokenizer(tokenizers.models.Unigram(vocab, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return library


def test_counts_against_library(pieces):
    library, own = _unigram_library(pieces), unigram.Counter(pieces)
    for text in _texts():
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_count_ties():
    """Many segmentations of one score: which wins shows in the number of tokens."""
    rng = random.Random(3)
    bytes_ = [(f"<0x{b:02X}>", -50.0) for b in range(256)]
    for _ in range(40):
        labels = {"▁", *("".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(14))}
        vocab = [("<unk>", 0.0), *bytes_, *((label, float(-rng.randint(1, 3) * len(label))) for label in sorted(labels))]
        library, own = _unigram_library(vocab), unigram.Counter(vocab)
        for _ in range(50):
            text = "".join(rng.choice("abc d") for _ in range(rng.randint(0, 25)))
            assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids), (vocab[257:], text)


def test_count_tokens(spark, sf, odd_docs, no_docs, pieces):
    library = _unigram_library(pieces)
    rows = unigram.count_tokens(odd_docs.withColumn("n_tokens", F.lit("x")), vocabulary(PIECES), ("doc_id", "text")).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows)
    assert unigram.count_tokens(no_docs, vocabulary(PIECES)).collect() == []
    found = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op4_token_counts"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        assert found[r["doc_id"]] == len(library.encode(r["text"] or "", add_special_tokens=False).ids)


def _expected_ids(rows, library):
    start = 0
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_pieces_against_library(byte_library):
    own = tokenfiles.Encoder(tokenfiles.read_file(vocabulary(BYTE_BPE)))
    texts = _texts()
    ids, sizes = own.encode(texts, 0)
    at = 0
    for text, size in zip(texts, sizes):
        assert ids[at : at + size].tolist() == byte_library.encode(text, add_special_tokens=False).ids + [0], repr(text)
        at += size
    assert at == len(ids)


def test_tokens_query(spark, sf, byte_library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    found = sorted(tuple(r) for r in QUERIES["op10_tokens"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert found == list(_expected_ids([(r["doc_id"], r["text"]) for r in docs], byte_library))


def test_token_files(spark, odd_docs, no_docs, byte_library, tmp_path):
    index = tokenfiles.write_tokens(odd_docs.withColumn("part", F.lit(1)), vocabulary(BYTE_BPE), f"file://{tmp_path}/a", length=128)
    rows = index.collect()
    assert len(rows) == odd_docs.count()
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r["doc_id"], []).append(byte_library.encode(r["text"] or "", add_special_tokens=False).ids + [0])
    for r in rows:
        reader = tokenfiles.Reader(r["file"])
        assert reader.span(r["start_in_file"], r["n_tokens"]).tolist() in texts[r["doc_id"]]
        first = reader.sequence(r["start_in_file"] // 128)
        assert len(first["ids"]) == len(first["used"]) == 128 and first["used"][r["start_in_file"] % 128]
        last = r["start_in_file"] + r["n_tokens"] - 1
        assert reader.sequence(last // 128)["ends"][last % 128]
    for file in {r["file"] for r in rows}:  # an ordinary Arrow stream, with every used place once
        table = pa.ipc.open_stream(pa.memory_map(file.removeprefix("file://"))).read_all()
        assert table.schema.field("ids").type.list_size == 128
        used = sum(pa.compute.sum(c.flatten().cast(pa.int64())).as_py() or 0 for c in table["used"].chunks)
        assert used == sum(r["n_tokens"] for r in rows if r["file"] == file)
    nothing = tokenfiles.write_tokens(no_docs, vocabulary(BYTE_BPE), f"file://{tmp_path}/b")
    assert tokenfiles.read_tokens(nothing).collect() == []


def test_pieces_are_forgotten_by_halves(monkeypatch):
    monkeypatch.setattr(tokenfiles, "KEPT_PIECES", 60)
    path = vocabulary(BYTE_BPE)
    encoder, library = tokenfiles.Encoder(tokenfiles.read_file(path)), tokenizers.Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rng = random.Random(4)
    texts = [" ".join(rng.choice(("the", "of", f"word{rng.randrange(400)}", "é")) for _ in range(12)) for _ in range(200)]
    most = 0
    for i in range(0, 200, 3):
        ids, sizes = encoder.encode(texts[i : i + 3], 0)
        most = max(most, len(encoder.known))
        wanted = [[*e.ids, 0] for e in library.encode_batch(texts[i : i + 3], add_special_tokens=False)]
        assert np.split(ids, np.cumsum(sizes)[:-1])[0].tolist() == wanted[0] and ids.tolist() == sum(wanted, [])
    assert most < 150


class _Counted(dict):
    asked = 0

    def get(self, *key):
        self.asked += 1
        return super().get(*key)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


def test_each_piece_is_asked_for_once(byte_library):
    """Of many repeated words a batch looks up the different ones, and marks of any kind do not make new words."""
    own = tokenfiles.Encoder(tokenfiles.read_file(vocabulary(BYTE_BPE)))
    own.known = _Counted()
    texts = ["A stone, stone$$$ stone&&& stone-stone (stone) stone12\n" * 500, "stone; stone's　stone"] * 2
    ids, sizes = own.encode(texts, 0)
    wanted = [[*e.ids, 0] for e in byte_library.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == sum(wanted, []) and sizes.tolist() == list(map(len, wanted))
    assert sorted(p for p in own.known if b"stone" in p) == [b" stone", b"stone"]
    assert own.known.asked < 100


def test_pieces_beside_odd_characters():
    """Short batches of white space of several bytes, contractions, other scripts and special tokens, one inside another."""
    file = json.loads(tokenfiles.read_file(vocabulary(BYTE_BPE)))
    first = file["added_tokens"][0]
    more = (first["content"] + "x", "PAD", " \n", "é　")
    file["added_tokens"] += [first | {"id": first["id"] + 1 + i, "content": content} for i, content in enumerate(more)]
    content = json.dumps(file)
    own, library = tokenfiles.Encoder(content.encode()), tokenizers.Tokenizer.from_str(content)
    characters = "aaelstdv''' \n\t\r\x00\x1c.,$-_<|>019éÀÿ×÷ªµ½\x85\xa0     　​、日…́😀Ⅷ"
    parts = [*characters, "'s", "'re", "  ", first["content"], *more]
    rng = random.Random(6)
    batches = [[], [""], ["", ""], ["é"], ["　"], ["×"]]
    batches += [["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(rng.randint(1, 4))] for _ in range(3000)]
    for texts in batches:
        ids, sizes = own.encode(texts, 0)
        wanted = [[*e.ids, 0] for e in library.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == sum(wanted, []) and sizes.tolist() == list(map(len, wanted)), texts
