r"""Secret scans: fixed patterns, and a battery of randomness tests.

Patterns (``assign``, ``access``, ``hex``) are matched in every text, leftmost
and without overlap for each kind.  The battery looks at every run of 16 or
more characters of ``[A-Za-z0-9+/_-]`` that no non-ASCII Latin letter and no
combining mark continues (other neighbours delimit it as ASCII ones do):

* The smallest encoding whose alphabet holds the run is inferred: hex, base32,
  base36, base62 or base64.  Digits only are numbers, and runs without a digit
  are words unless they hold both capitals (besides the first character) and
  small letters; both are left out.
* A run of no alphabet, that is one that holds ``+`` or ``/`` together with ``-``
  or ``_``, is tested in its longest parts that have one: between ``-`` and
  ``_``, and between ``+`` and ``/``.  Of overlapping finds the longest is
  reported.
* Over the positions of the characters in that alphabet: a chi-squared test of
  uniformity (and one over digits, capitals and small letters), a runs test
  about the middle, a serial correlation test, and a test of neighbouring
  characters against those of words, numbers and identifiers.  Fisher's method
  combines them to one p-value: even for random strings, near 0 for all others.
* Length-aware false-discovery control.  The hypothesis is that a run is not
  random.  Its null distribution is that of the p-values of made-up names,
  slugs, paths and numbers of the same encoding and length class (a fixed
  sample with a fitted tail, ``null_of``).  Over the
  different runs of the whole table, each once however often it stands in the
  texts, Benjamini and Hochberg's step-up rule at FDR gives each pool of cells
  (encoding and length class; sparse ones go with neighbouring lengths) its
  level, and the null turns the level into a p-value for each cell.  Short runs,
  where names look random more often, need a higher one than long runs; a cell
  where even the highest would be too common among names flags nothing.

Spans found that way are of kind ``random``; those that overlap a pattern's
span are left out.  Offsets are code points, ends exclusive.  Null texts count
as empty; rows are scanned one by one, repeated ones too.  An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import table
from odflow.llm.spotsigs import ANCHORS
from odflow.llm.textvec import stretches

# The patterns of the base scan.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "random")
MIN_GROUP, MIN_ACCESS, MIN_HEX = 6, 20, 24

MIN_RUN = 16
FDR = 0.05
#: p-values are counted by their logarithm, eight bins for each power of ten; the last holds all below 1e-12.
BINS_OF_TEN, BINS = 8, 97
#: Cells of fewer different runs go with the neighbouring length class.
SPARSE = 50
#: Made-up names of a cell's null distribution; its upper TAIL is smoothed.
NULLS, TAIL, TAIL_Z = 1500, 0.1, 1.2816
#: p-values are not told apart below this.
LEAST_P = 1e-300
#: Length classes begin at these lengths.
LENGTHS = (16, 20, 24, 32, 40, 48, 64, 96)
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"), ("hex", _DIGITS + "ABCDEF"), ("base32", _LOWER.upper() + "234567"),
    ("base36", _DIGITS + _LOWER), ("base36", _DIGITS + _LOWER.upper()), ("base62", _DIGITS + _LOWER.upper() + _LOWER),
    ("base64", _LOWER.upper() + _LOWER + _DIGITS + "+/"), ("base64", _LOWER.upper() + _LOWER + _DIGITS + "-_"),
)
#: A run with a match of both has no one alphabet.
MIXED = re.compile("[-_]"), re.compile("[+/]")
REDACTED = "[SECRET]"

# Words whose letter pairs count as word-like ...
PROSE = """
about above after again against almost alone along already although always among another answer around because become before
began behind being believe below between beyond bring brought building business called came cannot carry certain change
children church city clear close coming common company complete could country course cover cross different doing door
during each early earth enough even every example experience family father feel field figure first follow force form found
friend further general girl give government great ground group hand hard having head heard heart help high himself history
home house however human hundred idea important increase interest itself keep kind knew know land language large last later
learn leave letter light like line little live local long look made make many matter mean might mind money moment morning
mother move much music must name national nature near need never night nothing notice number often once open order other
over own paper part people perhaps person picture place plant play point possible power present problem public question
quite rather reach read real reason remember right river room round said same school second seem sentence several shall
short should side simple since small social society some something sometimes sound south special stand start state still
story street strong study such sure system take talk tell than their them then there these they thing think this those
thought three through time today together told took toward tree true turn under until upon usually very voice walk want
watch water week well went were what when where which while white whole why within without woman word work world would
write year young nicht werden haben sein eine einen gegen durch ohne zwischen schon immer jahr zeit mensch leben arbeit
heute morgen abend freund strasse wasser stadt schule pour dans avec sans toujours jamais encore monde temps homme femme
maison ville jour nuit enfant travail pays porque cuando siempre nunca todavia mundo tiempo hombre mujer casa ciudad noche
"""
# ... and other words, from which names, slugs and paths are made up.
NAMES = """
account action active adapter admin agent alert align alpha android apache api app archive array article asset async audio
auth author avatar background backup badge banner base batch binary block blog body bold border bottom branch browser bucket
buffer build bundle button byte cache calendar callback camera canvas cart catalog category center channel chart check chunk
class client clip cloud cluster code color column comment commit compile config connect console container content context
control cookie copy core count create cursor custom daily dashboard data database date debug default delete deploy desktop
detail device dialog digest directory disk display docker document domain download draft driver dump edit editor element
email embed enable encode endpoint engine entry error event export extension factory feature feed fetch file filter flag
folder font footer format frame function gallery gateway generic git global graph grid handler hash header height hidden
hook host html http icon image import inbox index init inline input insert install instance integer interface internal
invoice item java javascript job json kernel key label layout legacy length level library license limit link linux list
listener loader lock log login logo mail main manager manifest map mapping margin market master media member memory menu
merge message meta method metric migration mobile mode model module monitor node null object offset online option output
owner package page panel parent parse partition password patch path payload payment photo pipeline pixel platform player
plugin pointer policy popup port portal post prefix preview print private process product profile project prompt property
protocol provider proxy python query queue random range record recipe redirect region release remote render reply report
request reset resource response result review role root router row runtime sample scale schema scope screen script scroll
search section secure select sensor server service session setting setup shadow share shop sidebar signal size slide slot
snapshot socket software source space sprite stack stage static status storage store stream string style submit summary
support sync tab table tag target task template tenant test text theme thread thumb ticket title toggle token toolbar topic
trace tracker transaction transfer type unit update upload user utility valid value vector vendor version video view virtual
visitor volume warning web website widget width window wrapper xml zone berlin bericht bild datei kunde madrid oferta paris
produit rechnung suche termin usuario verkauf
"""
HEX_NAMES = "add added bad bade bead bed beef cab cafe dad dead deaf decade deed ebb face facade fade faded fed fee feed".split()


def _upper_tail(x: float, df: int) -> float:
    """P(chi-squared with df degrees of freedom >= x), Wilson and Hilferty."""
    z = ((max(x, 0.0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return max(LEAST_P, 0.5 * math.erfc(z / math.sqrt(2)))


def _two_sided(z: float) -> float:
    return max(LEAST_P, math.erfc(abs(z) / math.sqrt(2)))


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def _pairs(alphabet: str) -> tuple[np.ndarray, float, float, float]:
    """Log-likelihood of each character after each other one in names and
    numbers; its mean, variance and covariance of neighbours in random strings."""
    letters = np.full((26, 26), 0.3)
    for word in [*PROSE.split(), *ANCHORS]:
        for a, b in zip(word, word[1:]):
            if a in _LOWER and b in _LOWER:
                letters[_LOWER.index(a), _LOWER.index(b)] += 1
    letters /= letters.sum(axis=1, keepdims=True)
    after = ((0.65, 0.1, 0.05, 0.2), (0.05, 0.8, 0.05, 0.1), (0.06, 0.45, 0.42, 0.07), (0.2, 0.6, 0.15, 0.05))
    gain = np.zeros((len(alphabet), len(alphabet)))
    for i, a in enumerate(alphabet):
        for j, b in enumerate(alphabet):
            x, y = _kind(a), _kind(b)
            if y == 0:
                step = (int(b) - int(a)) % 10 if x == 0 else 2
                within = 0.2 if step < 2 else 0.075 if x == 0 else 0.1
            elif y == 3:
                within = 0.5
            else:
                within = letters[_LOWER.index(a.lower()), _LOWER.index(b.lower())] if (x, y) in ((1, 1), (2, 2), (2, 1)) else 1 / 26
            gain[i, j] = math.log(after[x][y] * within)
    mean = float(gain.mean())
    return gain, mean, float(gain.var()), float(((gain.mean(axis=0) - mean) * (gain.mean(axis=1) - mean)).mean())


PAIRS = {alphabet: _pairs(alphabet) for _, alphabet in ENCODINGS}


def continues(c: str) -> bool:
    """Whether a character beside a run makes it part of a longer word: a
    Latin letter outside ASCII, or a combining mark."""
    if c < "\x80":
        return False
    name = unicodedata.name(c, "")
    return c.isalpha() and "LATIN " in name or name.startswith("COMBINING ")


def infer_encoding(run: str) -> tuple[str, str] | None:
    """(name, alphabet), or None for words, numbers and mixed alphabets."""
    chars = set(run)
    if run.isdigit():
        return None
    if not any(c.isdigit() for c in chars) and (run[1:].islower() or run[1:].isupper() or run.isupper() or run.islower()):
        return None
    return next(((name, a) for name, a in ENCODINGS if chars <= set(a)), None)


def randomness(run: str, alphabet: str) -> float:
    """Combined p-value of the battery; random strings have even p-values."""
    k, n = len(alphabet), len(run)
    v = np.array([alphabet.index(c) for c in run], np.float64)
    bins = int(min(k, max(2, n // 5)))
    size = np.bincount(np.arange(k) * bins // k, minlength=bins)
    seen = np.bincount((v.astype(int) * bins) // k, minlength=bins)
    expected = n * size / k
    p = [_upper_tail(float(((seen - expected) ** 2 / expected).sum()), bins - 1)]
    kinds = np.array([0 if c.isdigit() or not c.isalnum() else 1 + c.isupper() for c in alphabet])
    if k > 16:
        present = np.unique(kinds)
        got = np.array([sum(kinds[alphabet.index(c)] == x for c in run) for x in present])
        share = np.array([(kinds == x).sum() for x in present]) * n / k
        p.append(_upper_tail(float(((got - share) ** 2 / share).sum()), len(present) - 1))
    above = v >= k / 2
    a, b = int(above.sum()), int((~above).sum())
    if a and b:
        runs = 1 + int((above[1:] != above[:-1]).sum())
        mean = 2 * a * b / n + 1
        var = max(1e-9, (mean - 1) * (mean - 2) / (n - 1))
        p.append(_two_sided((runs - mean) / math.sqrt(var)))
    else:
        p.append(1e-12)
    d = v - (k - 1) / 2
    p.append(_two_sided(float((d[1:] * d[:-1]).sum()) / ((k * k - 1) / 12 * math.sqrt(n - 1))))
    gain, mean, var, cov = PAIRS[alphabet]
    at = v.astype(int)
    z = (float(gain[at[:-1], at[1:]].sum()) - (n - 1) * mean) / math.sqrt((n - 1) * var + 2 * (n - 2) * cov)
    p.append(max(LEAST_P, 0.5 * math.erfc(z / math.sqrt(2))))
    return _upper_tail(-2 * sum(math.log(x) for x in p), 2 * len(p))


def candidates(run: str) -> list[tuple[int, str, tuple[str, str]]]:
    """(start in the run, string, encoding) of what is tested: the run, or the
    parts of a run of mixed alphabets."""
    if found := infer_encoding(run):
        return [(0, run, found)]
    if not (MIXED[0].search(run) and MIXED[1].search(run)):
        return []
    parts = {}
    for cut in MIXED:
        at = 0
        for part in cut.split(run):
            if len(part) >= MIN_RUN and (found := infer_encoding(part)):
                parts[at, part] = found
            at += len(part) + 1
    return [(at, part, found) for (at, part), found in sorted(parts.items())]


def cell(run: str, name: str) -> str:
    return f"{name}:{max(c for c in LENGTHS if c <= len(run))}"


def _bin(p: float) -> int:
    return min(BINS - 1, int(-math.log10(p) * BINS_OF_TEN))


#: Least p-value of each bin but the last.
EDGES = 10.0 ** (-np.arange(1, BINS) / BINS_OF_TEN)


def _made_up(r: random.Random, alphabet: str, size: int) -> str:
    """A name, slug, path or number over the alphabet, of words, short forms,
    numbers and plain sequences."""
    style = r.choice((str.lower, str.upper, str.capitalize, str.capitalize))
    between = r.choice(["", *[c for c in alphabet if not c.isalnum()] * 2])
    words = HEX_NAMES if len(alphabet) == 16 else NAMES.split()
    parts, length = [], 0
    while length < size:
        word, t = r.choice(words), r.random()
        if t < 0.55:
            part = style(word)
        elif t < 0.7:      # a short form
            part = style(word[:r.randint(2, 4)] if r.random() < 0.5 else word[0] + "".join(c for c in word[1:] if c not in "aeiou"))
        elif t < 0.93:
            part = r.choice((str(r.randint(0, 99)), f"{r.randint(0, 9999):04d}", str(r.randint(1990, 2030)), str(r.randint(0, 10 ** 6)),
                             f"{r.randint(1990, 2030)}{r.randint(1, 12):02d}{r.randint(1, 28):02d}", f"{r.randint(0, 99999):08d}"))
        elif t < 0.97:
            part = r.choice(alphabet) * r.randint(2, 8)
        else:
            first = r.randrange(len(alphabet))
            part = alphabet[first:first + r.randint(3, 10)]
        part = "".join(c for c in part if c in alphabet)
        parts.append(part)
        length += len(part) + len(between)
    return between.join(parts)[:size]


_NULLS: dict[str, np.ndarray] = {}


def null_of(name: str) -> np.ndarray:
    """For each of EDGES, the share of made-up names of a cell whose p-value
    is no less: their share of a fixed sample, and in its upper TAIL a normal
    law of the root of the logarithm, through that point and the median."""
    if name not in _NULLS:
        encoding, low = name.split(":")
        low = int(low)
        high = next((c for c in LENGTHS if c > low), 2 * low)
        alphabets = [a for e, a in ENCODINGS if e == encoding]
        r, logs = random.Random(name), []
        while len(logs) < NULLS:
            run = _made_up(r, r.choice(alphabets), r.randrange(low, high))
            found = infer_encoding(run)
            if len(run) >= low and found and found[0] == encoding:
                logs.append(math.log10(randomness(run, found[1])))
        roots, at = np.sort(np.sqrt(-np.array(logs))), np.sqrt(-np.log10(EDGES))
        start, middle = np.quantile(roots, (TAIL, 0.5))
        z = TAIL_Z * (middle - at) / (middle - start)
        tail = np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z])
        _NULLS[name] = np.where(at < start, tail, np.searchsorted(roots, at, "right") / NULLS)
    return _NULLS[name]


def pools(cells: dict[str, np.ndarray]) -> list[dict[str, np.ndarray]]:
    """The cells' counts in pools of one encoding and neighbouring length
    classes: of at least SPARSE runs each, if the encoding has as many."""
    out = []
    for encoding in sorted({k.split(":")[0] for k in cells}):
        own: list[dict[str, np.ndarray]] = []
        for k in sorted((k for k in cells if k.split(":")[0] == encoding), key=lambda k: int(k.split(":")[1])):
            if not own or _runs_of(own[-1]) >= SPARSE:
                own.append({})
            own[-1][k] = cells[k]
        if len(own) > 1 and _runs_of(own[-1]) < SPARSE:
            last = own.pop()
            own[-1] |= last
        out += own
    return out


def _runs_of(pool: dict[str, np.ndarray]) -> int:
    return sum(int(x.sum()) for x in pool.values())


def stepped_up(pool: dict[str, np.ndarray], fdr: float) -> dict[str, float]:
    """Benjamini and Hochberg's rule over the runs of a pool: the least
    p-value flagged in each of its cells."""
    null = {k: null_of(k) for k in pool}
    runs = _runs_of(pool)
    for level in sorted({float(q) for x in null.values() for q in x if q * runs <= fdr * runs}, reverse=True):
        # null shares rise from edge to edge
        last = {k: int(np.searchsorted(x, level, "right")) for k, x in null.items()}
        if level * runs <= fdr * sum(int(pool[k][:b].sum()) for k, b in last.items()):
            return {k: float(EDGES[b - 1]) for k, b in last.items() if b}
    return {}


class Scanner:
    """Finds in a column which texts can hold a match, over whole stretches of
    bytes, and scans only those."""

    def __init__(self) -> None:
        self.assign, self.access, self.hex = re.compile(f"(?ai){ASSIGN}"), re.compile(ACCESS), re.compile(HEX + r"(?<=[0-9a-f]{%d})" % MIN_HEX)
        self.run = np.zeros(256, bool)
        self.run[[ord(c) for c in _DIGITS + _LOWER + _LOWER.upper() + "+/_-"]] = True
        self.is_hex = np.zeros(256, bool)
        self.is_hex[[ord(c) for c in _DIGITS + "abcdef"]] = True
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    @staticmethod
    def _runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the runs of at least ``least`` set bytes inside a text."""
        first, last = mask.copy(), mask.copy()
        first[1:] &= ~mask[:-1]
        last[:-1] &= ~mask[1:]
        full = offsets[:-1] < offsets[1:]
        first[offsets[:-1][full]] = mask[offsets[:-1][full]]
        last[offsets[1:][full] - 1] = mask[offsets[1:][full] - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        long = e - s >= least
        return s[long], e[long]

    def stretch(self, data: np.ndarray, offsets: np.ndarray, base: bool) -> Iterator[tuple[int, str, dict, list]]:
        """(text number, text, base spans by kind, runs (start, end, run)) of
        the texts that can have any."""
        s, e = self._runs(self.run[data], offsets, MIN_RUN)
        # runs that a Latin letter outside ASCII or a mark continues are parts of words
        inside = np.searchsorted(offsets, s, "right") - 1
        near = np.zeros(len(s), bool)
        left, right = s > offsets[inside], e < offsets[inside + 1]
        near[left] |= data[s[left] - 1] >= 128
        near[right] |= data[e[right]] >= 128
        for i in np.flatnonzero(near):
            before = data[max(offsets[inside[i]], s[i] - 4):s[i]].tobytes().decode(errors="ignore")[-1:]
            after = data[e[i]:min(offsets[inside[i] + 1], e[i] + 4)].tobytes().decode(errors="ignore")[:1]
            near[i] = continues(before) or continues(after)
        s, e, inside = s[~near], e[~near], inside[~near]
        digit, small, capital = (np.concatenate([[0], np.cumsum((data >= a) & (data <= b))]) for a, b in ((48, 57), (97, 122), (65, 90)))
        # an encoding needs a digit, or letters of both cases
        some = (digit[e] > digit[s]) | (small[e] > small[s]) & (capital[e] > capital[s + 1])
        s, e, inside = s[some], e[some], inside[some]
        wanted = set(inside.tolist())
        raw = data.tobytes()
        if base:
            low = self.lower[data].tobytes()
            for text, words in ((low, KEYWORDS), (raw, (b"AKIA",))):
                for w in words:
                    at = text.find(w)
                    while at >= 0:
                        d = int(np.searchsorted(offsets, at, "right")) - 1
                        wanted.add(d)
                        at = text.find(w, int(offsets[d + 1]))
            h, _ = self._runs(self.is_hex[data], offsets, MIN_HEX)
            wanted.update((np.searchsorted(offsets, h, "right") - 1).tolist())
        for d in sorted(wanted):
            part = raw[offsets[d]:offsets[d + 1]]
            text = part.decode()
            runs = []
            for a, b in zip(s[inside == d] - offsets[d], e[inside == d] - offsets[d]):
                start = len(part[:a].decode())
                runs.append((start, start + int(b - a), part[a:b].decode()))
            yield d, text, self.base_spans(text) if base else {}, runs

    def base_spans(self, text: str) -> dict[str, list[tuple[int, int]]]:
        return {
            "assign": [m.span() for m in self.assign.finditer(text) if len(m.group(2)) >= MIN_GROUP],
            "access": [m.span() for m in self.access.finditer(text) if len(m.group()) >= MIN_ACCESS],
            "hex": [m.span() for m in self.hex.finditer(text)]}


def thresholds(docs: DataFrame, text: str = "text", fdr: float = FDR) -> dict[str, float]:
    """Lowest p-value flagged in each cell of encoding and length class, from
    the counts of different runs over all texts (a fixed number of cells and
    bins; runs are told apart by 64 bits of a hash)."""
    def run(batches):
        scanner = Scanner()
        for batch in batches:
            seen: dict[str, tuple[str, int, int]] = {}
            for _, data, offsets in stretches(batch.column(0)):
                for _, _, _, runs in scanner.stretch(data, offsets, False):
                    for _, r, found in [c for _, _, whole in runs for c in candidates(whole)]:
                        if r not in seen:
                            own = int.from_bytes(hashlib.blake2b(r.encode(), digest_size=8).digest(), "big", signed=True)
                            seen[r] = cell(r, found[0]), _bin(randomness(r, found[1])), own
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in seen.values()], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64()))], ["cell", "bin", "run"])

    runs = docs.select(text).mapInArrow(run, "cell string, bin int, run long").distinct()
    rows = runs.groupBy("cell", "bin").agg(F.count("*").alias("n")).collect()
    cells: dict[str, np.ndarray] = {}
    for r in rows:
        cells.setdefault(r["cell"], np.zeros(BINS, np.int64))[r["bin"]] = r["n"]
    return {k: x for pool in pools(cells) for k, x in stepped_up(pool, fdr).items()}


def spans_of(base: dict, runs: list, limits: dict[str, float]) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind."""
    spans = [(k, a, b) for k in KINDS[:3] for a, b in base.get(k, [])]
    taken = [(a, b) for _, a, b in spans]
    for first, _, whole in runs:
        finds = []
        for at, r, found in candidates(whole):
            a, b = first + at, first + at + len(r)
            if cell(r, found[0]) in limits and all(b <= x or a >= y for x, y in taken):
                if randomness(r, found[1]) >= limits[cell(r, found[0])]:
                    finds.append((a - b, a, b))
        for _, a, b in sorted(finds):
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                spans.append(("random", a, b))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(spans: list) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, a, b in spans])


def redacted(text: str, spans: list) -> str:
    out, at = [], 0
    for _, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], REDACTED]
        at = b
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, keep: list[str], text: str = "text", limits: dict[str, float] | None = None) -> DataFrame:
    """The columns ``keep`` with the counts of each pattern, base_sha256,
    spans, and ``clean_text``: the text with secrets replaced."""
    if limits is None:
        limits = thresholds(docs, text)
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    schema += ", n_assign long, n_access long, n_hex long, base_sha256 string, spans string, clean_text string"
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            n, column = batch.num_rows, batch.column(batch.num_columns - 1)
            counts = np.zeros((3, n), np.int64)
            digests, spans, changed = [nothing] * n, [""] * n, {}
            for row, data, offsets in stretches(column):
                for d, value, base, runs in scanner.stretch(data, offsets, True):
                    found = spans_of(base, runs, limits)
                    if not found:
                        continue
                    for i, k in enumerate(KINDS[:3]):
                        counts[i, row + d] = len(base[k])
                    digests[row + d] = hashlib.sha256(_joined([s for s in found if s[0] != "random"]).encode()).hexdigest()
                    spans[row + d] = _joined(found)
                    changed[row + d] = redacted(value, found)
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if i < len(keep)}
            columns |= {f"n_{k}": pa.array(counts[i]) for i, k in enumerate(KINDS[:3])}
            columns |= {"base_sha256": pa.array(digests), "spans": pa.array(spans, pa.string())}
            columns["clean_text"] = column if not changed else pa.array([changed.get(i, t) for i, t in enumerate(column.to_pylist())], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return picked.mapInArrow(run, schema)


def op8_randomness_battery(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, ["doc_id"]).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
