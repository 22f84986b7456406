import hashlib
import json
import random
import unicodedata

import ahocorasick
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from odflow.llm import bpe as B

PATH = public_tokenizers.path("word_bpe_49k.json")
SPEC = B.read_spec(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def mine():
    return B.load(B.read_spec(PATH))


def strange():
    r = random.Random(1)
    out = ["", "   ", "Hello, it's we'LL don't", "<|endoftext|> a <|startoftext|>b<|x|>", "ΑΣ ΣΑΣ", "İ ǅ ß ẞ", "a\x1cb\x1dc\x85d\xa0e​f　g",
           "\x00a\x00b", "🤗🏽‍♂️ x", "１２３ ½ ²", "a" * 700, "'''s't're", "café 가"]
    parts = ["a", "b", "the", "ing", "'s", "'", "ll", " ", "\n", "é", "ß", "Σ", "9", "0x", "_", "-", "<|", "|>", "́", "zz", "qu", "\x1f", "中", "😀"]
    out += ["".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(1500)]
    return out + ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(1, 25))) for _ in range(1500)]


def test_ids_and_decoding_match_the_library(library, mine, small_docs):
    texts = strange() + [t for _, t in small_docs]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert mine.encode(text) == want.ids, text[:80]
        assert mine.decode(want.ids) == library.decode(want.ids, skip_special_tokens=False)


def test_every_token_of_the_vocabulary_can_be_its_own_encoding(mine, library):
    r = random.Random(3)
    for token in r.sample(sorted(t for t in mine.vocab if t.endswith("</w>") and t[:-4].isascii() and t[:-4].islower() and t[:-4].isalpha()), 2000):
        word = token[:-4]
        assert mine.encode_word(word) == library.encode(word, add_special_tokens=False).ids


def test_query(spark, edge_dir, empty_dir, library):
    got = B.op7_bpe_round_trip(spark, edge_dir).collect()
    rows = spark.read.parquet(f"{edge_dir}/documents.parquet").collect()

    def want(r):
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        return (r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert sorted(map(str, map(tuple, got))) == sorted(str(want(r)) for r in rows)
    assert B.op7_bpe_round_trip(spark, empty_dir).count() == 0


def test_encode_returns_ids(spark, mine):
    df = B.encode(spark.createDataFrame([(1, "two words", "x")], "ids_of long, text string, ids string"), B.read_spec(PATH), ["ids_of"])
    r = df.first()
    assert r.ids == mine.encode("two words") and r.n_tokens == len(r.ids) and r.decoded == mine.decode(r.ids)


def test_every_code_point_is_encoded_as_the_library_does():
    """Each by itself; those that Unicode versions agree on many to a text."""
    bpe_, lib = B.load(SPEC), Tokenizer.from_str(SPEC)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    agreed = [c for c in points if not bpe_.is_disputed(c)]
    other = [c for c in points if bpe_.is_disputed(c) and c < chr(B.LAST_SCRIPTS)] + [chr(c) for c in range(0xE0000, 0xE0200)] + ["\U0010ffff", "\U00040000"]
    assert len(agreed) > 140_000
    texts = [" ".join(agreed[i:i + 500]) for i in range(0, len(agreed), 500)] + other
    for text, want in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
        assert bpe_.encode(text) == want.ids, ascii(text[:40])


def test_combining_marks_and_new_characters():
    bpe_, lib = B.load(SPEC), Tokenizer.from_str(SPEC)
    r = random.Random(5)
    points = [chr(c) for c in range(0x32400) if not 0xD800 <= c < 0xE000]
    marks = [c for c in points if unicodedata.category(c).startswith("M")]
    texts = ["".join(r.choice(marks if r.random() < 0.3 else points if r.random() < 0.6 else " aZ1'é᷺᫄") for _ in range(r.randrange(1, 9)))
             for _ in range(20_000)]
    for text, want in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
        assert bpe_.encode(text) == want.ids, ascii(text)


def test_memories_stay_bounded_inside_a_text(monkeypatch):
    monkeypatch.setattr(B, "MEMORY", 50)
    monkeypatch.setattr(B, "CHUNKS", 20)
    bpe_, lib = B.load(SPEC), Tokenizer.from_str(SPEC)
    text = " ".join(f"word{i} x" for i in range(2000))
    assert bpe_.encode(text) == lib.encode(text, add_special_tokens=False).ids
    assert len(bpe_.seen) <= 50 + 2 * 20 and len(bpe_.chunks_seen) <= 50 + 20


def test_a_symbol_without_a_token_is_an_error():
    spec = json.loads(SPEC)
    bpe_ = B.Bpe(spec)
    bpe_.found = ahocorasick.Automaton()
    bpe_.found.add_word("zz", (1, 2))
    bpe_.found.make_automaton()
    with pytest.raises(ValueError, match="no token"):
        bpe_.encode_word("abc")
