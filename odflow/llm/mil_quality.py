"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words.  Every passage is encoded
from its own bytes and words (shares of byte classes, word lengths, how much
of it the document said before, signed hash counts of its words), then by one
learned layer.  Gated attention, learned from document labels alone, weighs
the passages; the weighted mean of their codes gives the score.

Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not 1.
The fit uses a bounded sample: for each label the TRAIN_ROWS rows of smallest
id hash, of at most TRAIN_PASSAGES passages each, until they have half of
TRAIN_TOTAL passages (all that is ever on the driver, plus one row); the
score's offset is then set to the label shares of all rows open to training.  Scoring covers every
passage of every text.  Label, language, source and id never enter a score.

Null and empty texts are one passage without words.  Labels: null ones are
ignored, several for one id count as their largest.  With labels of one kind
or none, every score is the (smoothed) share of label 1.  Repeated rows are
scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import table, uniform_key
from odflow.llm.textvec import WordHasher, shingles, stretches

PASSAGE = 64
TRAIN_ROWS = 3000
TRAIN_PASSAGES = 400
TRAIN_TOTAL = 160_000
HASHED = 32
HIDDEN = 24
GATE = 12
EPOCHS = 150

#: Byte classes: listed punctuation by itself, the rest by kind.
_ALONE = b"!#$%&*|<>=.,;:?-_/\"'()[]{}@"


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 0, np.int64)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 4
    kind[[9, 11, 12, 13, 32]], kind[10] = 5, 6
    for i, b in enumerate(_ALONE):
        kind[b] = 7 + i
    return kind


_CLASSES = 7 + len(_ALONE)
N_FEATURES = _CLASSES + HASHED + 6


class PassageEncoder:
    """Features of all passages of the texts of an Arrow column."""

    def __init__(self) -> None:
        self.hasher = WordHasher(9)
        self.kind = _byte_classes()

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, features, first passage of each text and the end)."""
        for row, data, offsets in stretches(column):
            h, bounds, s, e = self.hasher.words(data, offsets)
            n = np.diff(bounds)
            count = np.maximum(1, -(-n // PASSAGE))
            bags = np.concatenate([[0], np.cumsum(count)])
            total = int(bags[-1])
            inside = np.arange(len(h)) - np.repeat(bounds[:-1], n)
            of_word = np.repeat(bags[:-1], n) + inside // PASSAGE
            size = np.bincount(of_word, minlength=total).astype(np.float64)
            # a passage's bytes go from its first word to the next passage's
            begin = np.repeat(offsets[:-1], count)
            later = np.flatnonzero(inside % PASSAGE == 0)
            later = later[inside[later] > 0]
            begin[of_word[later]] = s[later]
            width = np.diff(np.append(begin, offsets[-1]))
            of_byte = np.repeat(np.arange(total), width)
            kinds = np.bincount(of_byte * _CLASSES + self.kind[data], minlength=total * _CLASSES).reshape(total, _CLASSES)
            x = np.zeros((total, N_FEATURES), np.float32)
            x[:, :_CLASSES] = kinds / np.maximum(width, 1)[:, None]
            bin_ = (h >> np.uint64(59)).astype(np.int64)
            sign = 1.0 - 2.0 * (h & np.uint64(1)).astype(np.float64)
            hashed = np.bincount(of_word * HASHED + bin_, sign, minlength=total * HASHED).reshape(total, HASHED)
            words = np.maximum(size, 1)
            x[:, _CLASSES:_CLASSES + HASHED] = hashed / np.sqrt(words)[:, None]
            length = (e - s).astype(np.float64)
            mean = np.bincount(of_word, length, minlength=total) / words
            same = np.zeros(len(h), bool)
            same[1:] = (h[1:] == h[:-1]) & (inside[1:] > 0)
            x[:, -6] = np.bincount(of_word, same, minlength=total) / words
            x[:, -5] = np.log1p(size)
            x[:, -4] = mean / 10
            x[:, -3] = np.sqrt(np.maximum(0, np.bincount(of_word, length * length, minlength=total) / words - mean * mean)) / 10
            x[:, -2] = self._again(h, bounds, of_word, total) / words
            g, at = shingles(h, bounds, 4)
            wide = np.where(n >= 4, n - 3, n > 0)
            start = np.repeat(bounds[:-1], wide) + np.arange(len(g)) - np.repeat(at[:-1], wide)
            x[:, -1] = self._again(g, at, of_word[start], total) / words
            yield row, x, bags

    @staticmethod
    def _again(values: np.ndarray, bounds: np.ndarray, where: np.ndarray, total: int) -> np.ndarray:
        """How many values of each passage the document had before."""
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = np.lexsort((values, doc))
        v, d = values[order], doc[order]
        same = np.zeros(len(v), bool)
        same[1:] = (v[1:] == v[:-1]) & (d[1:] == d[:-1])
        return np.bincount(where[order[same]], minlength=total).astype(np.float64)


class GatedAttention:
    """code = tanh(x W + b); weight ~ exp(w . (tanh(code V) * sigmoid(code U)));
    score = sigmoid(c . sum(weight * code) + d)."""

    def __init__(self, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        self.p = {
            "W": r.normal(0, N_FEATURES**-0.5, (N_FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
            "V": r.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "U": r.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "w": r.normal(0, GATE**-0.5, GATE), "c": r.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale, self.offset = np.zeros(N_FEATURES), np.ones(N_FEATURES), 0.0
        self.constant: float | None = None

    def forward(self, x: np.ndarray, bags: np.ndarray) -> tuple:
        p = self.p
        code = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(code @ p["V"]), 1 / (1 + np.exp(-(code @ p["U"])))
        weight = np.exp(np.clip((t * g) @ p["w"], -30, 30))
        size = np.diff(bags)
        weight /= np.repeat(np.add.reduceat(weight, bags[:-1]), size)
        z = np.add.reduceat(weight[:, None] * code, bags[:-1], axis=0)
        return code, t, g, weight, z, z @ p["c"] + p["d"][0]

    def scores(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags) - 1, self.constant)
        logit = self.forward((x - self.mean) / self.scale, bags)[-1] + self.offset
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def fit(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray, shares: tuple[float, float]) -> None:
        """Adam on the log loss, both labels weighing alike; then the offset
        moves to the given numbers of rows with label 0 and 1."""
        if y.min() == y.max():
            raise ValueError("labels of both kinds are needed")
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = (x - self.mean) / self.scale
        size = np.diff(bags)
        row_weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        for step in range(1, EPOCHS + 1):
            code, t, g, weight, z, logit = self.forward(x, bags)
            p = self.p
            dl = (1 / (1 + np.exp(-logit)) - y) * row_weight
            dz = np.repeat(dl[:, None] * p["c"], size, axis=0)
            d_code = weight[:, None] * dz
            dw = (dz * code).sum(axis=1)
            dw = weight * (dw - np.repeat(np.add.reduceat(weight * dw, bags[:-1]), size))
            dt, dg = dw[:, None] * p["w"] * g * (1 - t * t), dw[:, None] * p["w"] * t * g * (1 - g)
            d_code += dt @ p["V"].T + dg @ p["U"].T
            da = d_code * (1 - code * code)
            grad = {"W": x.T @ da + 1e-4 * p["W"], "b": da.sum(axis=0), "V": code.T @ dt, "U": code.T @ dg,
                    "w": (t * g).T @ dw, "c": z.T @ dl + 1e-4 * p["c"], "d": np.array([dl.sum()])}
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                p[k] = p[k] - 0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.offset = float(np.log((shares[1] + 1) / (shares[0] + 1)))


def held_out(doc_id="doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame) -> GatedAttention:
    """``docs`` (doc_id, text), ``labels`` (doc_id, quality); other columns are not looked at."""
    labels = (labels.filter("doc_id is not null and quality is not null").filter(~held_out())
              .groupBy("doc_id").agg(F.max("quality").cast("int").alias("_y")))
    shares = {r["_y"]: r["count"] for r in labels.filter("_y in (0, 1)").groupBy("_y").count().collect()}
    key = uniform_key(F.col("doc_id"), F.lit("train"))
    sample = None
    for y in (0, 1):
        part = labels.filter(F.col("_y") == y).orderBy(key, "doc_id").limit(TRAIN_ROWS)
        sample = part if sample is None else sample.unionByName(part)

    def features(batches):
        encoder = PassageEncoder()
        for batch in batches:
            ids, ys, xs = [], [], []
            for row, x, bags in encoder(batch.column(2)):
                for d in range(len(bags) - 1):
                    if bags[d + 1] - bags[d] <= TRAIN_PASSAGES:
                        ids.append(batch.column(0)[row + d].as_py())
                        ys.append(batch.column(1)[row + d].as_py())
                        xs.append(x[bags[d]:bags[d + 1]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ys, pa.int32()), pa.array(xs, pa.binary())], ["doc_id", "y", "x"])

    # at most 2 * TRAIN_ROWS ids: small enough to send everywhere
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(sample.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id")).select("doc_id", "_y", "text")
    rows = picked.mapInArrow(features, "doc_id long, y int, x binary")
    rows = rows.groupBy("doc_id", "y").agg(F.min("x").alias("x")).orderBy(key, "doc_id")
    # in order of the key, partition by partition, until a label has its passages: no more than that is ever held
    held: list[tuple[int, int, np.ndarray]] = []
    left = {0: TRAIN_TOTAL // 2, 1: TRAIN_TOTAL // 2}
    for r in rows.toLocalIterator():
        x = np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES)
        if left[r["y"]] > 0:
            left[r["y"]] -= len(x)
            held.append((r["doc_id"], r["y"], x))
        elif max(left.values()) <= 0:
            break
    held.sort(key=lambda h: h[0])
    y = np.array([h[1] for h in held])
    model = GatedAttention()
    if len(set(y.tolist())) < 2:
        n0, n1 = shares.get(0, 0), shares.get(1, 0)
        model.constant = (n1 + 1) / (n0 + n1 + 2)
        return model
    bags = np.concatenate([[0], np.cumsum([len(h[2]) for h in held])])
    model.fit(np.concatenate([h[2] for h in held]).astype(np.float64), bags, y, (shares.get(0, 0), shares.get(1, 0)))
    return model


def score(docs: DataFrame, model: GatedAttention, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score`` and ``predicted``."""
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]) + ", score double, predicted int"

    def run(batches):
        encoder = PassageEncoder()
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for row, x, bags in encoder(batch.column(batch.num_columns - 1)):
                out[row:row + len(bags) - 1] = model.scores(x, bags)
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if i < len(keep)}
            columns["score"], columns["predicted"] = pa.array(out), pa.array((out >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_pydict(columns)

    return picked.mapInArrow(run, schema)


def op9_attention_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.select("doc_id", "quality"))
    return score(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")
