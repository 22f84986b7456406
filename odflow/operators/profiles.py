"""Hourly profiles: long -> wide pivot, per-row shares, cluster assignment."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.session import checkpoint_dir

#: Rows (a day each) that the starts of a k-means may be sent; beyond, fits pass over the table, so many at a time.
MAX_SHARED_ROWS = 50_000
START_THREADS = 4

HOURS = list(range(24))


def hour_col(h: int) -> str:
    return f"h{h:02d}"


HOUR_COLS = [hour_col(h) for h in HOURS]


def pivot_hours(df: DataFrame, index: str, hour: str, value: str) -> DataFrame:
    """One row per ``index`` with 24 columns ``h00..h23``.

    Pivot values are given, so Spark needs no extra pass to find them and
    hours outside 0..23 are ignored.  A cell with no data is NULL; an hour
    absent from the whole frame is 0 (its column did not exist before the
    re-index).  The presence flags are one global aggregate, read as a
    scalar subquery: Spark runs it once and uses the value as a constant.
    ``df`` is read for both, so callers pass stored totals.
    """
    wide = df.groupBy(index).pivot(hour, HOURS).agg(F.sum(value))
    present = df.agg(F.array(*[F.max((F.col(hour) == h).cast("int")) for h in HOURS])).scalar()
    cols = [
        F.when(F.coalesce(F.col("_p")[h], F.lit(0)) == 1, F.col(f"`{h}`")).otherwise(F.lit(0.0)).cast("double").alias(hour_col(h))
        for h in HOURS
    ]
    return wide.withColumn("_p", present).select(index, *cols)


def row_total(cols: list[str]) -> Column:
    return F.aggregate(F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in cols]), F.lit(0.0), lambda a, v: a + v)


def normalise_rows(df: DataFrame, cols: list[str] = HOUR_COLS, prefix: str = "s") -> DataFrame:
    """Each value over its row total; missing or 0/0 becomes 0."""
    with_total = df.withColumn("_total", F.nullif(row_total(cols), F.lit(0.0)))
    shares = [F.coalesce(F.try_divide(F.col(c), F.col("_total")), F.lit(0.0)).alias(f"{prefix}{c[1:]}") for c in cols]
    return with_total.select(*df.columns, *shares)


def share_cols(prefix: str = "s") -> list[str]:
    return [f"{prefix}{h:02d}" for h in HOURS]


def assign_nearest(df: DataFrame, feature_cols: list[str], centres: list[list[float]], out: str = "cluster") -> DataFrame:
    """Label each row with the 1-based index of its nearest centre (squared distance)."""
    feats = F.array(*[F.col(c).cast("double") for c in feature_cols])
    dists = []
    for i, c in enumerate(centres):
        cen = F.array(*[F.lit(float(v)) for v in c])
        d = F.aggregate(F.zip_with(feats, cen, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
        dists.append(F.struct(d.alias("d"), F.lit(i + 1).alias("k")))
    best = F.array_min(F.array(*dists))["k"]   # ties: the lower index wins
    return df.withColumn(out, best)


def first_rows_as_centres(df: DataFrame, order_col: str, feature_cols: list[str], k: int) -> list[list[float]]:
    """Feature vectors of the first ``k`` rows by ``order_col`` (a deterministic initialisation).

    Collects exactly ``k`` rows to the driver.
    """
    rows = df.orderBy(order_col).limit(k).select(*feature_cols).collect()
    return [[float(v) for v in r] for r in rows]


def refined_kmeans(x: np.ndarray, k: int, random: np.random.Generator) -> tuple[float, np.ndarray]:
    """(inertia, centres) of one start: spread-out first centres, means until
    they stay, then single rows moved while a move lowers the inertia, the best
    move first.  What is left is a local optimum under both steps."""
    centres = x[[random.integers(len(x))]]
    while len(centres) < k:
        far = ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1)
        centres = np.vstack([centres, x[random.choice(len(x), p=far / far.sum())]])
    label = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    while True:
        size = np.bincount(label, minlength=k)
        centres = np.stack([np.bincount(label, c, k) for c in x.T], axis=1) / np.maximum(size, 1)[:, None]
        d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        nearest = d.argmin(axis=1)
        if (nearest != label).any() and d[np.arange(len(x)), nearest].sum() < d[np.arange(len(x)), label].sum() - 1e-15:
            label = nearest
            continue
        own = np.arange(len(x)), label
        saved = np.where(size[label] > 1, d[own] * size[label] / np.maximum(size[label] - 1, 1), -np.inf)
        change = d * size / (size + 1) - saved[:, None]
        change[own] = np.inf
        row, to = np.unravel_index(change.argmin(), change.shape)
        if not change[row, to] < -1e-12:
            return float(d[own].sum()), centres
        label[row] = to


def _best_centres(df: DataFrame, feature_cols: list[str], k: int, seed: int, starts: int) -> list[list[float]]:
    """Centres of least inertia out of ``starts`` starts, each a task of one
    job; the rows, at most MAX_SHARED_ROWS, are sent to every task."""
    spark = df.sparkSession
    rows = df.select(*[F.col(c).cast("double") for c in feature_cols]).orderBy(*feature_cols).collect()
    shared = spark.sparkContext.broadcast(np.array([list(r) for r in rows], np.float64))

    def run(batches):
        for batch in batches:
            for start in batch.column(0).to_pylist():
                cost, centres = refined_kmeans(shared.value, k, np.random.default_rng([seed, start]))
                yield pa.RecordBatch.from_pydict({"cost": [cost], "start": [start], "centres": [centres.ravel().tolist()]})

    best = (spark.range(0, starts, 1, starts).mapInArrow(run, "cost double, start long, centres array<double>")
            .orderBy(F.round("cost", 12), "start").first())
    return np.array(best["centres"]).reshape(k, -1).tolist()


def kmeans_labels(df: DataFrame, feature_cols: list[str], k: int, seed: int, out: str = "cluster",
                  order_col: str | None = None, starts: int = 16) -> DataFrame:
    """Fit k-means on the feature columns and label rows 1..k.

    The best of ``starts`` seeded starts.  The input is one row per day: up to
    MAX_SHARED_ROWS rows are sent to the starts, which run as the tasks of one
    job and refine their result row by row (``refined_kmeans``); a larger table
    is fitted by Spark ML's k-means||, the fits side by side.  With
    ``order_col`` clusters are numbered by their least value of it, so labels
    say the same on every run.  Fails clearly when there are fewer distinct
    vectors than clusters (a k-means fit is undefined there); that check reads
    at most k rows.
    """
    # One row per day: materialise it once (reliable checkpoint in the
    # session's checkpoint folder) so the fits' passes and the labelling do
    # not recompute the fact scan behind it.
    checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    n_distinct = df.select(*feature_cols).distinct().limit(k).count()
    if n_distinct < k:
        raise ValueError(f"k-means needs at least k={k} distinct vectors, found {n_distinct}")
    if df.limit(MAX_SHARED_ROWS + 1).count() <= MAX_SHARED_ROWS:
        labelled = assign_nearest(df, feature_cols, _best_centres(df, feature_cols, k, seed, starts), out)
    else:
        labelled = _fitted_by_passes(df, feature_cols, k, seed, out, starts)
    if order_col is not None:
        firsts = labelled.groupBy(out).agg(F.min(order_col).alias("first"))
        numbers = firsts.agg(F.transform(F.sort_array(F.collect_list(F.struct("first", out))), lambda x: x[out])).scalar()    # k entries
        labelled = labelled.withColumn(out, F.array_position(numbers, F.col(out)).cast("int"))
    return labelled


def _fitted_by_passes(df: DataFrame, feature_cols: list[str], k: int, seed: int, out: str, starts: int) -> DataFrame:
    """The least inertia of ``starts`` distributed fits, START_THREADS at a time."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    feats = df.withColumn("_features", array_to_vector(F.array(*[F.col(c).cast("double") for c in feature_cols])))

    def fit(i: int):
        model = KMeans(k=k, seed=seed + i, featuresCol="_features", predictionCol="_pred", maxIter=300, tol=0.0).fit(feats)
        return model.summary.trainingCost, i, model

    with ThreadPool(START_THREADS) as pool:
        model = min(pool.imap_unordered(inheritable_thread_target(df.sparkSession)(fit), range(starts)), key=lambda x: x[:2])[2]
    return model.transform(feats).withColumn(out, F.col("_pred") + 1).drop("_features", "_pred")


def inertia(clustered: DataFrame, feature_cols: list[str], cluster: str = "cluster") -> Column:
    """Sum of the squared distances of all rows to the mean of their cluster,
    as a scalar subquery (one pass: squares less the squared sums over sizes)."""
    def spread(c: str) -> Column:
        return F.sum(F.col(c) * F.col(c)) - F.sum(c) * F.sum(c) / F.count("*")

    by_cluster = clustered.groupBy(cluster).agg(sum((spread(c) for c in feature_cols[1:]), spread(feature_cols[0])).alias("_spread"))
    return by_cluster.agg(F.sum("_spread")).scalar()
