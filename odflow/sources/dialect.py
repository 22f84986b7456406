"""Dialects of separated text files, found from the beginning of every file.

``sniff`` reads the first bytes of a file under every pair of a separator and a
quote and scores how even the lines come out: the share of lines with the usual
number of fields, times more for more fields, less for quotes left over inside
fields.  The encoding (a byte order mark, UTF-8, else Latin-1) comes first, the
header last.  Only this choice rests on a sample; reading is strict, so a line
further down that does not fit the dialect fails the load instead of being
cut, padded or misread.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

from odflow.sources import storage

#: In order of preference between equal scores: commas and semicolons also occur inside values.
SEPARATORS = "\t|;,"
QUOTES = ('"', "'", "")
SAMPLE_BYTES = 64 * 1024
READERS = 16
#: A separator that fewer lines than this agree on is none.
LEAST_EVEN = 0.5
NUMBER = re.compile(r"[+-]?[\d.,\s]*\d[\d.,\s]*%?$|\d{4}-\d\d-\d\d")


class UnknownDialect(ValueError):
    """A sample whose lines agree on no separator."""


@dataclass(frozen=True)
class Dialect:
    sep: str
    quote: str
    encoding: str
    header: bool
    columns: tuple[str, ...]


def decoded(sample: bytes, whole: bool) -> tuple[str, str]:
    """(text, encoding) of a sample; a character cut at its end is left out."""
    if sample.startswith(codecs.BOM_UTF8):
        sample, bom = sample[len(codecs.BOM_UTF8):], True
    else:
        bom = False
    try:
        return codecs.getincrementaldecoder("utf-8")().decode(sample, final=whole), "UTF-8"
    except UnicodeDecodeError:
        if bom:
            raise
        return sample.decode("latin-1"), "ISO-8859-1"


def lines_of(text: str, sep: str, quote: str) -> list[list[str]]:
    """The non-empty lines as fields, by a separator and a quote ('' for none)."""
    kind = {"quotechar": quote, "doublequote": True} if quote else {"quoting": csv.QUOTE_NONE}
    rows = csv.reader(io.StringIO(text, newline=""), delimiter=sep, **kind)
    try:
        return [r for r in rows if r]
    except csv.Error:
        return []


def evenness(rows: list[list[str]], quote: str) -> tuple[float, int, float]:
    """(share of lines with the usual number of fields, that number, share of
    fields with a quote left over)."""
    widths = Counter(map(len, rows))
    width, n = max(widths.items(), key=lambda x: (x[1], x[0]))
    left = ('"', "'") if not quote else (quote,)
    fields = [f for r in rows for f in r]
    stray = sum(any(f.startswith(q) or f.endswith(q) for q in left) for f in fields)
    return n / len(rows), width, stray / max(1, len(fields))


def _has_header(rows: list[list[str]], names: tuple[str, ...]) -> bool:
    """Whether the first line names the columns: it holds the names asked for;
    without such, it has no number where the lines below have some, and where
    all is text no first cell occurs again in its column."""
    first, body = [c.strip() for c in rows[0]], [r for r in rows[1:] if len(r) == len(rows[0])]
    if names:
        return set(names) <= set(cell_names(first))
    filled = [c for c in first if c]
    if len(filled) < len(first) - 1 or any(NUMBER.match(c) for c in filled):
        return False
    if not body:
        return True
    columns = list(zip(*body))
    numeric = [sum(bool(NUMBER.match(v.strip())) for v in c) > len(c) / 2 for c in columns]
    return any(numeric) or not any(name in map(str.strip, c) for name, c in zip(first, columns) if name)


def cell_names(first: list[str]) -> tuple[str, ...]:
    """Column names from a header line: blank cells are named by their place, repeated ones numbered."""
    out: list[str] = []
    for i, cell in enumerate(first):
        name, n = cell.strip() or f"column{i}", 0
        while name in out:
            n += 1
            name = f"{cell.strip()}_{n}"
        out.append(name)
    return tuple(out)


def sniff(sample: bytes, whole: bool = True, names: tuple[str, ...] = (), sep: str | None = None, quote: str | None = None) -> Dialect:
    """The dialect of a file from its first bytes (``whole``: all of them).

    ``names``: columns that a header must hold to be one.  ``sep`` and
    ``quote`` fix what is known.  A file of one column has no separator that
    lines could agree on, and must be given one.
    """
    text, encoding = decoded(sample, whole)
    if not whole:
        text = text[:max(text.rfind("\n"), 0) + 1] or text      # the last line may be cut
    if not text.strip():
        raise UnknownDialect("nothing but blank lines")
    best = None
    for s in SEPARATORS if sep is None else sep:
        for q in QUOTES if quote is None else (quote,):
            if q and q not in text and quote is None:
                continue
            rows = lines_of(text, s, q)
            if not rows:
                continue
            even, width, stray = evenness(rows, q)
            if sep is None and (width < 2 or even < LEAST_EVEN):
                continue
            score = even * even * (1 - 1 / (width + 1)) - stray
            if names and set(names) <= set(cell_names(rows[0])):
                score += 1                                       # the columns asked for are there
            if best is None or score > best[0]:
                best = score, s, q, rows
    if best is None:
        raise UnknownDialect("no separator that the lines agree on")
    _, s, q, rows = best
    header = _has_header(rows, names)
    columns = cell_names(rows[0]) if header else tuple(f"column{i}" for i in range(len(rows[0])))
    return Dialect(s, q or '"', encoding, header, columns)


def dialects(spark: SparkSession, paths: list[str], names: tuple[str, ...] = (), sep: str | None = None,
             quote: str | None = None, sample_bytes: int = SAMPLE_BYTES) -> dict[Dialect, list[str]]:
    """The files by dialect, each from its first ``sample_bytes`` bytes (after
    decompression); files without a line are left out.  Nothing else is read
    here, however large the files are."""
    def one(path: str) -> tuple[str, Dialect | None]:
        sample = storage.head(spark, path, sample_bytes + 1)
        if not sample.strip():
            return path, None
        try:
            return path, sniff(sample[:sample_bytes], len(sample) <= sample_bytes, names, sep, quote)
        except UnknownDialect as e:
            raise UnknownDialect(f"{path}: {e}") from None

    found: dict[Dialect, list[str]] = {}
    with ThreadPoolExecutor(READERS) as pool:
        for path, d in pool.map(one, paths):
            if d is not None:
                found.setdefault(d, []).append(path)
    return found
