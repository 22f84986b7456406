"""Percent ranks by ranges, and the best of several k-means starts."""

import itertools
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from odflow.operators import profiles
from odflow.operators.ranking import percent_rank

CASES = {
    "different": [float(i) for i in range(40)],
    "ties over borders": [1.0] * 15 + [2.0] * 3 + [3.0] * 25,
    "one value": [7.0] * 30,
    "nulls": [None] * 9 + [1.0, 1.0, 2.0] + [None] * 4,
    "one row": [5.0],
    "nothing": [],
}


@pytest.mark.parametrize("values", CASES.values(), ids=CASES)
@pytest.mark.parametrize("ranges", [1, 2, 7])
def test_percent_rank_is_that_of_one_window(spark, values, ranges):
    values = list(enumerate(values))
    random.Random(3).shuffle(values)
    df = spark.createDataFrame(values, "id long, v double").repartition(4)
    want = df.withColumn("p", F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last())))
    got = percent_rank(df, "v", "p", ranges)
    key = lambda d: sorted((r.id, r.v, r.p) for r in d.collect())
    assert got.columns == ["id", "v", "p"] and key(got.fillna(-1.0)) == key(want.fillna(-1.0))


def test_ties_are_spread_and_no_window_takes_all_rows(spark):
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 1D, cast(id as double)) as v")
    out = percent_rank(df, "v", "p", ranges=10)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line and "_value" in line]
    assert windows and all("_range" in line.split("], [")[1] for line in windows)
    stored_rows = out.filter("v = 1").select("p").distinct().count()
    assert stored_rows == 1 and out.count() == 3000


@pytest.mark.parametrize("shared", [50_000, 3])
def test_kmeans_keeps_the_least_inertia_and_numbers_by_order(spark, monkeypatch, shared):
    """By tasks that hold the rows, and by distributed fits."""
    monkeypatch.setattr(profiles, "MAX_SHARED_ROWS", shared)
    r = random.Random(9)
    points = [[r.gauss(c, 0.6), r.gauss(c * c % 5, 0.6)] for c in (0, 2, 4) for _ in range(3)]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "i long, a double, b double")
    labelled = profiles.kmeans_labels(df, ["a", "b"], 3, 1, order_col="i", starts=8)
    got = labelled.select(profiles.inertia(labelled, ["a", "b"])).first()[0]

    def cost(labels):
        total = 0.0
        for c in set(labels):
            mine = [p for p, k in zip(points, labels) if k == c]
            mean = [sum(x) / len(mine) for x in zip(*mine)]
            total += sum((x - m) ** 2 for p in mine for x, m in zip(p, mean))
        return total

    best = min(cost(x) for x in itertools.product(range(3), repeat=len(points)) if len(set(x)) == 3)
    assert abs(got - best) < 1e-9
    labels = [r.cluster for r in labelled.orderBy("i").collect()]
    assert abs(cost(labels) - best) < 1e-9
    firsts = [labels.index(k) for k in (1, 2, 3)]
    assert firsts == sorted(firsts)
