"""Conversation repair: the auction against a search, and the query against plain Python."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict
from math import inf

import pytest

from odflow.llm import conversations as cv

AFTER = {"s": 1, "u": 2, "a": 3}


def search(rows):
    """Cheapest, then least letters, by a search over (cost, letters)."""
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        cost, letters, i, state = heapq.heappop(heap)
        if i > len(rows):
            return cost, letters
        if (i, state) in seen:
            continue
        seen.add((i, state))
        role = "uuau"[state]
        heapq.heappush(heap, (cost + 5, letters + "I", i, AFTER[role]))
        if i == len(rows):
            if state in (0, 3):
                heapq.heappush(heap, (cost, letters, i + 1, 0))
            continue
        heapq.heappush(heap, (cost + 2, letters + "D", i + 1, state))
        if rows[i] != "x":
            extra, initial = 5 * rows[i].isupper(), rows[i].lower()
            if initial == role or (initial == "s" and state == 0):
                heapq.heappush(heap, (cost + extra, letters + "K", i + 1, AFTER[initial]))
            heapq.heappush(heap, (cost + 1 + extra, letters + "R", i + 1, AFTER[role]))


def test_auction_finds_the_cheapest_and_least_letters():
    r, solve = random.Random(2), cv.Solver()
    for _ in range(4000):
        rows = "".join(r.choice("suaoSUAOxxuuaa") for _ in range(r.randrange(0, 10)))
        assert solve(rows) == search(rows), rows


def test_blocks_chain_to_the_whole():
    r = random.Random(3)
    for _ in range(800):
        rows = "".join(r.choice("suaoSUAOxua") for _ in range(r.randrange(1, 14)))
        k = r.randrange(1, 5)
        blocks, ends, known = [rows[i:i + k] for i in range(0, len(rows), k)], list(cv.TAIL), []
        for b in reversed(blocks):
            known.insert(0, tuple(ends))
            to = [cv.prices(b, tuple(0 if e == q else inf for q in range(4)))[0] for e in range(4)]
            ends = [min(to[e][q] + ends[e] for e in range(4)) for q in range(4)]
        state, letters = 0, ""
        for b, e in zip(blocks, known):
            more, state = cv.trace(b, cv.prices(b, e), state)
            letters += more
        assert (ends[0], letters + cv.TAIL_LETTERS[state]) == search(rows)


def expected(rows):
    """The rows of the query, by plain Python."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        keep = groups[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        r = zlib.crc32(key.encode()) % 20
        if r != 0:
            text = "" if r == 1 else re.sub("[.!?]", "", text) if r == 2 else text
            keep += [(turn, "user" if r == 4 else role, text)] * (2 if r == 3 else 1)
    out = []
    for conv, keep in groups.items():
        keep.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        faults, seen = [], set()
        for _, role, text in keep:
            end = re.sub(r"[\x20\x09-\x0d]+\Z", "", text)[-1:]
            faults.append("b" if not end else "d" if (role, text) in seen else "t" if end not in ".!?" else "-")
            seen.add((role, text))
        first = [role[:1] if role[:1] in ("s", "u", "a") else "o" for _, role, _ in keep]
        cost, audit = search("".join("x" if f in "bd" else i.upper() if f == "t" else i for i, f in zip(first, faults)))
        lines, i, state = [], 0, 0
        for letter in audit:
            role = "uuau"[state]
            if letter == "I":
                lines.append({"u": "user:", "a": "assistant:"}[role])
                state = AFTER[role]
                continue
            if letter in "KR":
                state = AFTER[first[i] if letter == "K" else role]
                lines.append(f"{keep[i][1] if letter == 'K' else {'u': 'user', 'a': 'assistant'}[role]}:{keep[i][2]}")
            i += 1
        turns = [t for t, _, _ in keep if t is not None]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows", [1, 4, 512])
def test_query_against_plain_python(spark, edge_dir, empty_dir, block_rows):
    for d in (edge_dir, "/root/testdata/sf0.001"):
        table = spark.read.parquet(f"{d}/conversations.parquet")
        got = cv.repair(cv.damaged(table), block_rows=block_rows)
        assert sorted([tuple(r) for r in got.collect()], key=repr) == expected([tuple(r) for r in table.collect()])
    assert cv.repair(cv.damaged(spark.read.parquet(f"{empty_dir}/conversations.parquet"))).count() == 0


def test_blocks_by_characters(spark, edge_dir):
    table = spark.read.parquet(f"{edge_dir}/conversations.parquet")
    got = cv.repair(cv.damaged(table), block_chars=20)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected([tuple(r) for r in table.collect()])
