"""Plain Python versions of what the operators compute."""

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingle_set(text, k):
    w = WORD.findall(lower_ascii(text or ""))
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def component_ids(sets, ids, num, den):
    """Smallest id reachable (None counts as no id); rows by position."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if den * shared >= num * (len(sets[i]) + len(sets[j]) - shared):
                    parent[find(i)] = find(j)
    best = defaultdict(list)
    for i, x in enumerate(ids):
        if x is not None:
            best[find(i)].append(x)
    return [min(best[find(i)], default=None) for i in range(len(sets))]


def mix(rows):
    """rows (doc_id, text, source) to (sizes, taken) by position."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    total = {s: sum(z for z, r in zip(size, rows) if r[2] == s) for s in sources}
    target, open_, left = {}, set(sources), 1.5 * sum(size)
    while open_:
        w = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / w > 2 * total[s]]
        if not full:
            target |= {s: left * weight[s] / w for s in open_}
            break
        for s in full:
            target[s] = 2.0 * total[s]
        left -= sum(target[s] for s in full)
        open_ -= set(full)
    taken = [0] * len(rows)
    for s in sources:
        mine = sorted((i for i, r in enumerate(rows) if r[2] == s and size[i]), key=lambda i: (
            hashlib.md5(str("" if rows[i][0] is None else rows[i][0]).encode()).hexdigest()[:13], rows[i][0] is not None, rows[i][0] or 0, size[i]))
        at, goal = 0, round(target[s])
        for i in mine:
            for e in range(2):
                a = at + e * total[s]
                taken[i] += max(0, min(a + size[i], goal) - a)
            at += size[i]
    return size, taken, target


def held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 3 == 1
