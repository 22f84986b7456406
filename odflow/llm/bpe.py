"""Byte-pair encoding and decoding by per-prefix dynamic programming.

A word (one match of the tokenizer's split pattern) is a sequence of byte
symbols, the last one marked as word end.  For every prefix of that sequence
exactly one token can be the last of the prefix's encoding.  Going left to
right, the vocabulary tokens that end at a position are listed by an
Aho-Corasick automaton over the vocabulary; a candidate is right when the
pair (last token of the prefix before it, candidate) is compatible, that is,
byte-pair encoding of the two put together gives the two back.  Compatibility
is decided from the merge table alone, by taking the two tokens apart along
their seam.  Following the stored last tokens back from the end gives the ids:
linear in the word, with no merge loop.

Texts are normalised as the tokenizer file says (NFC, lower case character by
character; white space only separates), special tokens in the text get their
own ids.  The split pattern never crosses white space, so texts are cut there
and equal chunks, and equal words in them, are encoded once per task; both
memories are emptied when they hold over MEMORY entries, inside a text too.
Texts with characters that Unicode versions disagree on, unassigned ones and
combining marks, are normalised and cut by the library's own normaliser and
splitter; the dynamic programming is the same.  Decoding maps ids back to byte
symbols, joined by a space each, as the library does for a file that names no
decoder.

Null texts count as empty: no ids, an empty decoded text.  Very long texts and
words only take longer, in proportion.  Rows are encoded one by one: repeated
rows, ties, other columns and empty tables need no special case.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import table

MEMORY = 120_000
#: Above, planes hold nothing but unassigned, private and variation characters.
LAST_SCRIPTS = 0x323B0
#: Rows whose results are held together, and chunks of a text looked up at a time.
SLICE = 500
CHUNKS = 50_000

# The white space of the tokenizer's \s.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Controls that Python's split takes for white space and the tokenizer does not.
NOT_WHITE = ("\x1c", "\x1d", "\x1e", "\x1f")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    characters for themselves, the others from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in own else chr(extra))
        extra += b not in own
    return out


def disputed() -> frozenset[str]:
    """Characters below LAST_SCRIPTS whose class or order depends on the version
    of Unicode: those that this Python's tables leave unassigned, and combining
    marks."""
    category = unicodedata.category
    return frozenset([c for c in map(chr, range(0x300, LAST_SCRIPTS)) if category(c) in ("Cn", "Mn", "Mc", "Me")])


class Bpe:
    """Encoder and decoder for a tokenizer file with a BPE model over byte
    symbols and a word-end suffix."""

    def __init__(self, spec: dict) -> None:
        self.spec, self.library, self.disputed = spec, None, None
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.symbols = byte_symbols()
        self.text_of = {i: t for t, i in self.vocab.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern.replace(r"\s", WHITE))
        self.white = regex.compile(f"[{WHITE}]+")
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        # the first merge that makes a token is the one that takes it apart
        for order, (left, right) in enumerate(model["merges"]):
            made = self.vocab[left + right]
            pair = (self.vocab[left], self.vocab[right])
            self.rank[pair] = (order, made)
            self.parts.setdefault(made, pair)
        # tokens as sequences over byte symbols and one end mark; the end mark is no symbol of its own
        self.end = "\x00"
        self.found = ahocorasick.Automaton()
        for token, i in self.vocab.items():
            word = token[: -len(self.suffix)] + self.end if token.endswith(self.suffix) and token != self.suffix else token
            size = len(word) - word.endswith(self.end)
            if size == 1 or i in self.parts:
                self.found.add_word(word, (i, size))
        self.found.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.seen: dict[str, tuple[str, int, str]] = {}         # words
        self.chunks_seen: dict[str, tuple[str, int, str]] = {}  # runs without white space

    def compatible(self, a: int, b: int) -> bool:
        """Undo merges on both sides of the seam, latest first; the two stay
        apart unless a pair across the seam would have merged before."""
        limit = len(self.rank)
        rank, parts = self.rank, self.parts
        while True:
            across = rank.get((a, b))
            if across is not None and across[0] < limit:
                return False
            ra = rank[parts[a]][0] if a in parts else -1
            rb = rank[parts[b]][0] if b in parts else -1
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                # a was made last: before that, its right part stood at the seam
                limit, a = ra, parts[a][1]
                across = rank.get((a, b))
                if across is not None and across[0] < limit:
                    return False
            else:
                limit, b = rb, parts[b][0]
                across = rank.get((a, b))
                if across is not None and across[0] <= limit:
                    return False

    def encode_word(self, word: str) -> list[int]:
        """Ids of one match of the split pattern."""
        return self.encode_symbols("".join([self.symbols[b] for b in word.encode()]))

    def encode_symbols(self, data: str) -> list[int]:
        """Ids of one match, given as byte symbols."""
        n, pairs = len(data), self.pairs
        if len(pairs) > MEMORY:
            pairs.clear()
        last, length = [-1] * (n + 1), [0] * (n + 1)
        # matches come by their end, so all shorter prefixes are done before
        for at, (token, size) in self.found.iter(data + self.end):
            # one over the end mark ends after the last symbol; unmarked tokens
            # there cannot end a whole word
            if at < n - 1:
                i = at + 1
            elif at == n:
                i = n
            else:
                continue
            if last[i] >= 0:
                continue
            if size < i:
                before = last[i - size]
                key = before << 20 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self.compatible(before, token)
                if not fits:
                    continue
            last[i], length[i] = token, size
        out, i = [], n
        while i:
            if last[i] < 0:
                raise ValueError(f"no token of the vocabulary ends at symbol {i} of {data!r}")
            out.append(last[i])
            i -= length[i]
        return out[::-1]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.text_of[i] for i in ids if i in self.text_of])

    def word(self, word: str) -> tuple[str, int, str]:
        found = self.seen.get(word)
        if found is None:
            ids = self.encode_word(word)
            found = self.seen[word] = (" ".join(map(str, ids)), len(ids), self.decode(ids))
        return found

    def chunk(self, chunk: str) -> tuple[str, int, str]:
        if chunk.isalpha():
            return self.word(chunk)
        parts = [self.word(w) for w in self.split.findall(chunk)]
        return " ".join([p[0] for p in parts]), sum([p[1] for p in parts]), " ".join([p[2] for p in parts])

    def by_library(self, text: str) -> list[tuple[str, int, str]]:
        """The parts of a text that the library normalises and cuts."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(json.dumps(self.spec))
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        all_ids = [self.encode_symbols(w) for w, _ in words]
        return [(" ".join(map(str, ids)), len(ids), self.decode(ids)) for ids in all_ids]

    def is_disputed(self, text: str) -> bool:
        if text.isascii():
            return False
        self.disputed = self.disputed or disputed()
        found = set(text)       # a text has few different characters
        return max(found) >= chr(LAST_SCRIPTS) or not self.disputed.isdisjoint(found)

    def chunks(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if not text.isascii():
            text = text.replace("\u03a3", "\u03c3")     # no final sigma: characters are lowered one by one
        text = text.lower()
        if any([c in text for c in NOT_WHITE]):
            return [x for x in self.white.split(text) if x]
        return text.split()

    def encode_parts(self, text: str) -> list[tuple[str, int, str]]:
        """(ids as text, number, decoded) of every chunk."""
        out = []
        for piece in self.special_split.split(text) if "<|" in text else [text]:
            if piece in self.special:
                i = self.special[piece]
                out.append((str(i), 1, self.decode([i])))
                continue
            if self.is_disputed(piece):
                out.extend(self.by_library(piece))
                continue
            chunks = self.chunks(piece)
            for start in range(0, len(chunks), CHUNKS):
                for memory in (self.seen, self.chunks_seen):
                    if len(memory) > MEMORY:
                        memory.clear()
                now, seen = chunks[start:start + CHUNKS], self.chunks_seen
                for c in set(now).difference(seen):
                    seen[c] = self.chunk(c)
                out.extend([seen[c] for c in now])
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _, _ in self.encode_parts(text) for i in ids.split()]


def load(spec_json: str) -> Bpe:
    return Bpe(json.loads(spec_json))


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _over_texts(docs: DataFrame, keep: list[str], text: str, spec: str, finish, schema: str) -> DataFrame:
    """``keep`` columns and what ``finish`` makes of the parts of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)     # the vocabulary: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, names = None, None
        for whole in batches:
            bpe = bpe or load(shared.value)
            names = names or [f.name for f in whole.schema][: len(keep)]
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                rows = [finish(bpe.encode_parts(t or "")) for t in batch.column(len(keep)).to_pylist()]
                columns = {k: batch.column(i) for i, k in enumerate(names)}
                for name, kind in kinds:
                    columns[name] = pa.array([r[name] for r in rows], kind)
                yield pa.RecordBatch.from_pydict(columns)

    kinds = [(f.split()[0], {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}[f.split()[1]])
             for f in schema.split(", ")]
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[: len(keep)])
    return picked.mapInArrow(run, f"{out}, {schema}" if out else schema)


def _numbers(parts: list[tuple[str, int, str]]) -> np.ndarray:
    return np.fromstring(" ".join([p[0] for p in parts]), np.int32, sep=" ")


def encode(docs: DataFrame, spec: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with ``ids`` (array), ``n_tokens`` and ``decoded``."""
    def finish(parts):
        ids = _numbers(parts)
        return {"n_tokens": len(ids), "ids": ids, "decoded": " ".join([p[2] for p in parts])}
    return _over_texts(docs, keep, text, spec, finish, "n_tokens long, ids array<int>, decoded string")


def encode_digest(docs: DataFrame, spec: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with the number of ids and the digests of the ids and
    of the decoded text; the ids themselves stay in the task."""
    def finish(parts):
        ids = " ".join([p[0] for p in parts])
        decoded = " ".join([p[2] for p in parts])
        return {"n_tokens": sum([p[1] for p in parts]),
                "ids_sha256": hashlib.sha256(ids.encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest()}
    return _over_texts(docs, keep, text, spec, finish, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_with_digest(docs: DataFrame, spec: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with the ids and the digest of the decoded text."""
    def finish(parts):
        ids = _numbers(parts)
        decoded = " ".join([p[2] for p in parts])
        return {"n_tokens": len(ids), "ids": ids, "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest()}
    return _over_texts(docs, keep, text, spec, finish, "n_tokens long, ids array<int>, decoded_sha256 string")


def op7_bpe_round_trip(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return encode_digest(table(spark, sf_dir, "documents"), read_spec(tokenizer), ["doc_id"])
