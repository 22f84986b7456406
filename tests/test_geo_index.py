"""The edge index of prepared geometries, and the spatial join without broadcast."""

import math
import random

import pytest
from pyspark.sql import functions as F

from odflow.functions import geo
from odflow.operators import joins
from odflow.queries import registry
from odflow.sources import fixtures as fx


def ring(n, radius=10.0, cx=0.0, cy=0.0, wave=0.0, turns=7):
    pts = [(cx + (radius + wave * math.sin(turns * 2 * math.pi * i / n)) * math.cos(2 * math.pi * i / n),
            cy + (radius + wave * math.sin(turns * 2 * math.pi * i / n)) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return [*pts, pts[0]]


def wkt(*rings):
    return "POLYGON(" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in rings) + ")"


def shapes(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, w string")
    return df.select("i", geo.geom_from_wkt("w").alias("g"))


def inside(pt, rings):
    """Even-odd ray cast in plain Python (no point of the tests lies on an edge)."""
    odd, (x, y) = False, pt
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:]):
            if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
                odd = not odd
    return odd


def edges_at_heights(spark, rings, heights):
    prepared = shapes(spark, wkt(*rings)).select(geo.prepare("g").alias("p"))
    ys = spark.createDataFrame([(float(y),) for y in heights], "y double")
    rows = prepared.crossJoin(ys).select(geo.edges_at("p", "y").alias("n"), F.size("p.members").alias("places")).collect()
    return [r.n for r in rows], rows[0].places


def test_edges_looked_at_grow_slower_than_the_ring(spark):
    r = random.Random(4)
    heights = [r.uniform(-9.99, 9.99) for _ in range(200)]
    seen = {}
    for n in (100, 1000, 10_000):
        counts, places = edges_at_heights(spark, [ring(n)], heights)
        seen[n] = sum(counts) / len(counts)
        assert places <= (geo.PLACES_PER_EDGE + 3) * n
    assert seen[10_000] <= 4 * math.log2(10_000) and seen[10_000] - seen[100] <= 4 * math.log2(100)


def test_index_of_a_comb_stays_small(spark):
    """Every long edge passes every height: the index must not grow with its square."""
    teeth = 600
    pts = [(i * 1.0, (0.0 if i % 2 else 10.0) + i * 1e-6) for i in range(2 * teeth)]
    comb = [*pts, (2 * teeth, -1.0), (0.0, -1.0), pts[0]]
    _, places = edges_at_heights(spark, [comb], [5.0])
    assert places <= (geo.PLACES_PER_EDGE + 3) * (2 * teeth + 3)
    prepared = shapes(spark, wkt(comb)).select(geo.prepare("g").alias("p"))
    r = random.Random(1)
    pts = [(r.uniform(-1, 2 * teeth), r.uniform(-0.9, 9.9)) for _ in range(100)]
    df = prepared.crossJoin(spark.createDataFrame(pts, "x double, y double"))
    got = df.select("x", "y", geo.st_contains_point("p", "x", "y", prepared=True).alias("c")).collect()
    assert all(row.c == inside((row.x, row.y), [comb]) for row in got)


@pytest.mark.parametrize("n", [3, 33, 500])
def test_points_in_prepared_rings(spark, n):
    r = random.Random(n)
    outer, hole = ring(n, 10, 1, 2, wave=3), ring(max(3, n // 2), 2, 1, 2)
    pts = [(r.uniform(-13, 15), r.uniform(-12, 16)) for _ in range(400)]
    pts += [outer[0], hole[1]]                                          # on the boundary: not contained, but covered
    df = shapes(spark, wkt(outer, hole)).select(geo.prepare("g").alias("p")).crossJoin(spark.createDataFrame(pts, "x double, y double"))
    got = {(row.x, row.y): (row.c, row.v) for row in df.select("x", "y", geo.st_contains_point("p", "x", "y", prepared=True).alias("c"),
                                                                 geo.st_covers_point("p", "x", "y", prepared=True).alias("v")).collect()}
    for p in pts[:-2]:
        assert got[p] == (inside(p, [outer, hole]),) * 2
    assert got[outer[0]] == got[hole[1]] == (False, True)


def test_ring_in_ring_with_few_comparisons(spark):
    n = 2000
    df = shapes(spark, wkt(ring(n, 10, wave=1)), wkt(ring(n, 8.9, wave=1)), wkt(ring(n, 9.5, wave=-1)))
    a, b, c = (df.filter(f"i = {i}").select(F.col("g").alias(k)) for i, k in enumerate("abc"))
    row = a.crossJoin(b).crossJoin(c).select(
        geo.st_contains("a", "b").alias("yes"), geo.st_contains("a", "c").alias("no"), geo.st_contains("b", "a").alias("larger"),
        F.size("a.edges").alias("n")).first()
    assert row.n == n and row.yes and not row.no and not row.larger
    meetings = a.select(geo.prepare("a").alias("a")).crossJoin(b).select(geo.edge_meetings("a", "b").alias("m")).first().m
    assert meetings <= 4 * n * math.log2(n) < n * n / 40


def test_empty_and_missing_geometries(spark):
    df = shapes(spark, "POLYGON((0 0, 1 0, 1 1, 0 0))").withColumn("none", F.when(F.col("i") > 5, F.col("g")))
    row = df.select(geo.prepare("none").alias("p"), geo.plain("none").alias("q"), geo.st_contains_point("none", "0D", "0D").alias("c")).first()
    assert row.p is None and row.q is None and not row.c
    back = df.select(geo.prepare("g").alias("p"), "g").select(geo.plain("p").alias("p"), "g").first()
    assert back.p == back.g


# ------------------------------------------------------------ the join by shuffle

def _tiles(spark):
    rows = [(f"t{i}{j}", wkt([(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j)])) for i in range(6) for j in range(6)]
    rows += [("wide", wkt([(-1, -1), (7, -1), (7, 7), (-1, 7), (-1, -1)])), ("tiny", wkt([(0.4, 0.4), (0.6, 0.4), (0.5, 0.6), (0.4, 0.4)]))]
    return spark.createDataFrame(rows, "name string, w string").select("name", geo.geom_from_wkt("w").alias("shape"))


def _points(spark, n):
    """A third in one cell, a third of these in one place; some outside, some null."""
    x = "CASE WHEN id % 3 = 0 THEN if(id % 9 = 0, 0.51D, pmod(id * 7919, 9973) / 9973D) WHEN id % 50 = 1 THEN -5D WHEN id % 101 = 2 THEN NULL ELSE pmod(id * 104729, 59999) / 10000D END"
    y = "CASE WHEN id % 3 = 0 THEN if(id % 9 = 0, 0.47D, pmod(id * 6101, 9967) / 9967D) ELSE pmod(id * 15485863, 59999) / 10000D END"
    return spark.range(n).selectExpr("id AS pid", f"{x} AS x", f"{y} AS y")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_shuffled_join_equals_the_broadcast_join(spark, how):
    pts, tiles = _points(spark, 3000), _tiles(spark)
    want = joins.spatial_join_points(pts, tiles, geom_col="shape", how=how)
    got = joins.spatial_join_points(pts, tiles, geom_col="shape", how=how, broadcast_budget=0, hot_rows=40)
    assert got.columns == want.columns
    key = lambda df: sorted((r.pid, r.name or "") for r in df.collect())
    assert key(got) == key(want) and got.filter("shape is not null").first().shape.kind == "Polygon"


def test_hot_cells_are_split_below_the_limit(spark):
    pts = _points(spark, 9000).filter("x is not null").withColumn("_pl", F.lit(0)).withColumn("_px", F.floor("x")).withColumn("_py", F.floor("y"))
    hot = joins.hot_cells(pts, "x", "y", 500).collect()
    assert [(r._hl, r._hx, r._hy) for r in hot] == [(0, 0, 0)]
    squares, starts = hot[0].squares, hot[0].starts
    assert starts == sorted(starts)
    in_cell = pts.filter("_px = 0 and _py = 0").collect()
    for s in squares:
        n = sum(s.x0 <= p.x < s.x1 and s.y0 <= p.y < s.y1 for p in in_cell)
        assert 0 < n <= 500 * s.pieces and (s.pieces == 1 or s.x1 - s.x0 == 2.0**-joins.QUAD_DEPTH)
    assert sum(s.x0 <= p.x < s.x1 and s.y0 <= p.y < s.y1 for p in in_cell for s in squares) == len(in_cell)


def test_no_part_of_the_join_gets_a_third_of_the_points(spark):
    """The keys that the join deals points by hold at most the limit each."""
    limit = 200
    joined = joins._shuffled_spatial_join(_points(spark, 9000), _tiles(spark), joins.grid_stats(_tiles(spark), "shape")[0], "x", "y", "shape", "left", limit)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_square" in plan and "_piece" in plan
    assert joined.groupBy("pid").count().count() == 9000
    quarters = list(joins.quadtree({0: 1000, 1: 10, 4095: 3}, 100))
    assert quarters == [(0, joins.QUAD_DEPTH, 10), (1, joins.QUAD_DEPTH, 1), (1024 * 3, 1, 1)] or sum(p for _, _, p in quarters) >= 11


def test_dear_rows_of_one_small_file_are_dealt_over_all_cores(spark, scratch):
    spark.range(5000).selectExpr("id c_custkey").coalesce(1).write.parquet(f"{scratch}/customer.parquet")
    cores = spark.sparkContext.defaultParallelism
    for name in ("polygon_with_holes", "polygon_in_polygon", "point_in_polygon", "wkt_parse", "centroid_xy"):
        df = registry()[name](spark, scratch)
        tasks = df.select(F.spark_partition_id().alias("t")).distinct().count()
        assert tasks >= 2 * cores, name
    spark.range(5000).selectExpr("if(id = 0, null, id) c_custkey").write.parquet(f"{scratch}/odd/customer.parquet")
    got = registry()["polygon_with_holes"](spark, f"{scratch}/odd")
    assert {(r.shape, r.n) for r in got.groupBy("shape").agg(F.count("*").alias("n")).collect()} == {(s, 5000) for s in fx.HOLE_SHAPES}
    assert got.filter("point_id is null and inside is null").count() == 3
