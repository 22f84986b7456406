"""Copies of a template side by side: every one is found."""

import random

import pyarrow as pa
import pytest

from odflow.llm import license_scan as L

WORDS = [f"w{i}x" for i in range(400)]
CASES = [(name, n) for name, texts in L.TEMPLATES.items() for n in range(len(texts))]


def found(text):
    for _, spans, data in L.LicenseScanner().column(pa.array([text])):
        return [(a, n, text.encode()[x:y].decode()) for a, n, _, x, y in spans]
    return []


@pytest.mark.parametrize("name,n", CASES)
def test_one_to_five_copies_at_any_distance(name, n):
    r, template = random.Random(f"{name}{n}"), L.TEMPLATES[name][n]
    for copies in range(1, 6):
        for between in (0, 1, 3, 20, 200):
            fill = lambda k: " ".join(r.choice(WORDS) for _ in range(k))
            text = fill(r.randrange(4)) + " " + (" " + fill(between) + " ").join([template] * copies) + " " + fill(r.randrange(4))
            got = found(text)
            assert [(a, b) for a, b, _ in got] == [(name, n)] * copies, (copies, between)
            assert all(t.rstrip("./") == template.rstrip("./") for _, _, t in got)


@pytest.mark.parametrize("name,n", [c for c in CASES if len(L.TEMPLATES[c[0]][c[1]].split()) > 30])
def test_edited_copies_side_by_side(name, n):
    """A word in 20 left out, changed or put in: still every copy."""
    r, words = random.Random(f"e{name}{n}"), L.TEMPLATES[name][n].split()
    for copies in (2, 3, 5):
        out = []
        for _ in range(copies):
            edited = list(words)
            for k in r.sample(range(len(words)), len(words) // 20):
                edited[k] = r.choice(["", "zzz", edited[k] + " yyy"])
            out.append(" ".join(edited))
        assert [(a, b) for a, b, _ in found(" ".join(out))] == [(name, n)] * copies
