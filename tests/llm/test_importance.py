"""Importance resampling: the table, the hashes, and the query against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from odflow.llm import importance
from odflow.llm.gramtable import Bytes, Crc, GramTable
from tests.llm.brute import lower_ascii

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def buckets_of(text):
    w = WORD.findall(lower_ascii(text or ""))
    return w, [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def expected(docs, target):
    s, t = [0] * 10_000, [0] * 10_000
    found = [buckets_of(x) for _, x in docs]
    for _, f in found:
        for b in f:
            s[b] += 1
    for x in target:
        for b in buckets_of(x)[1]:
            t[b] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (big_s + 10_000) / ((a + 1) * (big_t + 10_000)))) for a, b in zip(s, t)]
    out = []
    for (i, _), (w, f) in zip(docs, found):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= 20))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = [(r[:4], k + 1) for k, r in enumerate(able[:5 * len(able) // 100])]
    return sorted(map(repr, (r[:4] for r in out))), sorted(map(repr, ranks))


def test_hashes_are_those_of_the_libraries():
    r = random.Random(1)
    data = np.frombuffer(r.randbytes(6000), np.uint8)
    starts = np.array([r.randrange(5000) for _ in range(2000)])
    sizes = np.array([r.choice([r.randrange(0, 70), r.randrange(0, 600)]) for _ in range(2000)])
    pieces = [data[a:a + n].tobytes() for a, n in zip(starts, sizes)]
    assert Bytes(data).xxh64(starts, sizes).tolist() == [xxhash.xxh64_intdigest(p) for p in pieces]
    assert Bytes(data).crc32(starts, sizes).tolist() == [zlib.crc32(p) for p in pieces]
    crc = Crc()
    for _ in range(200):
        a, b = r.randbytes(r.randrange(30)), r.randbytes(r.randrange(256))
        joined = crc.joined(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))
        assert joined[0] == zlib.crc32(a + b)


def test_strings_of_one_key_have_slots_of_their_own():
    class OneKey(Bytes):
        def xxh64(self, starts, lengths):
            return np.full(len(starts), 77, np.uint64)

    words = [b"a", b"ab", b"abcdefgh", b"abcdefghi", b"abcdefghj", b"a", b"abcdefghj", b"b", b"ab"] * 3
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    t = GramTable(OneKey(data), np.cumsum(sizes) - sizes, sizes)
    slots = {w: {t.slots[i] for i, x in enumerate(words) if x == w} for w in words}
    assert all(len(s) == 1 for s in slots.values()) and len(set().union(*slots.values())) == len(set(words)) == len(t.used)
    assert t.count[t.slots].tolist() == [words.count(w) for w in words]


@pytest.mark.parametrize("block", [1, 7, 1 << 18])
def test_blocks_do_not_change_the_features(small_docs, block):
    texts = [t for _, t in small_docs[:12 if block == 1 else 60]] + [None, "", "a", "a b", "x" * 600 + " y " + "z" * 300 + " w", "é漢字 ABC É"]
    got = [[] for _ in texts]
    for _, _, tables, where in importance.Features(block=block).blocks(pa.array(texts)):
        for t, rows in zip(tables, where):
            for row, bucket in zip(rows, t.bucket[t.slots].tolist()):
                got[row].append(bucket)
    assert [sorted(g) for g in got] == [sorted(buckets_of(t)[1]) for t in texts]


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    return sorted(repr(r[:4]) for r in rows), sorted(repr((r[:4], r[4])) for r in rows if r[4] is not None)


def test_query_against_plain_python(spark, edge_dir, empty_dir, monkeypatch):
    monkeypatch.setattr(importance, "RANGE_ROWS", 50)       # several ranges
    for d in (edge_dir, "/root/testdata/sf0.001"):
        docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
        target = [r.text for r in spark.read.parquet(f"{d}/benchmark.parquet").select("text").collect()]
        assert rows_of(importance.op11_importance_resampling(spark, d)) == expected(docs, target)
    assert importance.op11_importance_resampling(spark, empty_dir).count() == 0


def test_equal_rows_share_the_draw_and_the_ranges(spark, monkeypatch):
    monkeypatch.setattr(importance, "RANGE_ROWS", 100)
    df = spark.range(1000).selectExpr("if(id < 700, 5L, id) as score", "if(id < 700, 1L, id) as doc_id")
    out = importance.ranked(df, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], 650)
    rows = sorted(out.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, 651))
    assert [r.score for r in rows] == sorted([*range(700, 1000), *[5] * 350], reverse=True)
