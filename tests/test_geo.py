import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from odflow.functions import geo

SQUARE = "POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))"


def _geom_df(spark, *wkts):
    return spark.createDataFrame([(w,) for w in wkts], "wkt string").select("wkt", geo.geom_from_wkt("wkt").alias("g"))


def test_point_on_edge_not_contained(spark):
    r = _geom_df(spark, SQUARE).select(
        geo.st_contains_point("g", "2D", "1D").alias("edge"),
        geo.st_contains_point("g", "0D", "0D").alias("vertex"),
        geo.st_contains_point("g", "1D", "1D").alias("inside"),
        geo.st_covers_point("g", "2D", "1D").alias("covers_edge"),
    ).first()
    assert (r.edge, r.vertex, r.inside, r.covers_edge) == (False, False, True, True)


def test_point_in_hole_not_contained(spark):
    g = _geom_df(spark, "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))")
    r = g.select(geo.st_contains_point("g", "2D", "2D").alias("hole"), geo.st_contains_point("g", "0.5D", "0.5D").alias("ring")).first()
    assert (r.hole, r.ring) == (False, True)


def test_polygon_containment_cases(spark):
    outer = geo.geom_literal_sql(spark, SQUARE)
    df = _geom_df(
        spark,
        "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))",          # touches the edge from inside
        "POLYGON((1 1, 3 1, 3 2, 1 2, 1 1))",          # half outside
        "POLYGON((0.5 0.5, 1.5 0.5, 1.5 1.5, 0.5 1.5, 0.5 0.5))",
        "POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))",          # equal shapes
    )
    got = [r.c for r in df.select(geo.st_contains(outer, "g").alias("c")).collect()]
    assert got == [True, False, True, True]


def test_polygon_across_concave_notch(spark):
    concave = geo.geom_literal_sql(spark, "POLYGON((0 0, 4 0, 4 4, 2 2, 0 4, 0 0))")
    df = _geom_df(spark, "POLYGON((1 1, 3 1, 3 3, 1 3, 1 1))", "POLYGON((0.5 0.5, 3.5 0.5, 3.5 1, 0.5 1, 0.5 0.5))")
    assert [r.c for r in df.select(geo.st_contains(concave, "g").alias("c")).collect()] == [False, True]


def test_polygon_with_outer_hole_inside(spark):
    holed = geo.geom_literal_sql(spark, "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))")
    df = _geom_df(spark, "POLYGON((3 3, 7 3, 7 7, 3 7, 3 3))", "POLYGON((1 1, 2 1, 2 2, 1 2, 1 1))")
    assert [r.c for r in df.select(geo.st_contains(holed, "g").alias("c")).collect()] == [False, True]


def test_centroids(spark):
    df = _geom_df(
        spark,
        "POLYGON((0 0, 2 0, 2 2, 0 2, 0 0), (0.5 0.5, 1 0.5, 1 1, 0.5 0.5))",
        "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 1, 0 0)), ((10 0, 11 0, 11 1, 10 1, 10 0)))",
        "POLYGON((0 0, 0 2, 2 2, 2 0, 0 0))",          # clockwise shell
    )
    got = [(round(r.c.x, 6), round(r.c.y, 6)) for r in df.select(geo.st_centroid("g").alias("c")).collect()]
    assert got == [(1.005376, 1.010753), (5.5, 0.5), (1.0, 1.0)]


def test_wkt_geojson_round_trip(spark):
    wkt = "MULTIPOLYGON(((0 0, 3 0, 3 3, 0 3, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1)), ((5 5, 6 5, 6 6, 5 5)))"
    df = _geom_df(spark, wkt).select("g", geo.st_as_geojson("g").alias("js"))
    df = df.select("g", F.get_json_object("js", "$.type").alias("t"), F.regexp_extract("js", '"coordinates":(.*)}$', 1).alias("c"))
    back = df.select("g", geo.geom_from_geojson("t", "c").alias("h")).first()
    assert back.g.polys == back.h.polys and back.h.kind == "MultiPolygon"
    assert (back.h.xmin, back.h.ymin, back.h.xmax, back.h.ymax) == (0.0, 0.0, 6.0, 6.0)


def test_area(spark):
    r = _geom_df(spark, "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))").select(geo.st_area("g").alias("a")).first()
    assert r.a == 12.0


@settings(max_examples=10, deadline=None)
@given(
    st.integers(min_value=3, max_value=9),
    st.floats(min_value=0.5, max_value=5.0),
    st.lists(st.tuples(st.floats(-6, 6), st.floats(-6, 6)), min_size=5, max_size=20),
)
def test_point_in_convex_polygon_matches_half_planes(spark, n, radius, points):
    ring = [(radius * math.cos(2 * math.pi * i / n), radius * math.sin(2 * math.pi * i / n)) for i in range(n)]
    wkt = "POLYGON((" + ", ".join(f"{x!r} {y!r}" for x, y in ring + ring[:1]) + "))"
    poly = geo.geom_literal_sql(spark, wkt)
    df = spark.createDataFrame(points, "x double, y double")
    got = [r.c for r in df.select(geo.st_contains_point(poly, "x", "y").alias("c")).collect()]

    def inside(px, py):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1) <= 1e-9:
                return False
        return True

    exp = [inside(x, y) for x, y in points]
    # points within 1e-9 of an edge may go either way
    margin = [all(abs((x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)) > 1e-6
                  for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])) for px, py in points]
    assert [g for g, m in zip(got, margin) if m] == [e for e, m in zip(exp, margin) if m]


@settings(max_examples=8, deadline=None)
@given(st.floats(-50, 50), st.floats(-50, 50), st.floats(0.1, 5), st.floats(0.1, 5))
def test_centroid_translates(spark, dx, dy, w, h):
    base = f"POLYGON((0 0, {w!r} 0, {w!r} {h!r}, 0 {h!r}, 0 0))"
    moved = f"POLYGON(({dx!r} {dy!r}, {dx + w!r} {dy!r}, {dx + w!r} {dy + h!r}, {dx!r} {dy + h!r}, {dx!r} {dy!r}))"
    a, b = [r.c for r in _geom_df(spark, base, moved).select(geo.st_centroid("g").alias("c")).collect()]
    assert math.isclose(b.x, a.x + dx, abs_tol=1e-6) and math.isclose(b.y, a.y + dy, abs_tol=1e-6)


def test_shrunk_vertices_contained(spark):
    outer = geo.geom_literal_sql(spark, "POLYGON((0 0, 5 0, 6 3, 3 6, -1 4, 0 0))")
    inner = "POLYGON((0.25 0.5, 4.75 0.5, 5.6 3, 3 5.5, -0.5 3.9, 0.25 0.5))"
    r = _geom_df(spark, inner).select(geo.st_contains(outer, "g").alias("c")).first()
    assert r.c is True


def test_column_objects_rejected():
    with pytest.raises(TypeError):
        geo.st_centroid(F.col("g"))


def test_spatial_join_shuffle_path_matches_broadcast(spark):
    from odflow.operators.joins import spatial_join_points
    polys = spark.createDataFrame(
        [(1, "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))"), (2, "POLYGON((3 3, 8 3, 8 8, 3 8, 3 3))"),
         (3, "POLYGON((10 10, 12 10, 11 12, 10 10))")], "pid int, w string",
    ).select("pid", geo.geom_from_wkt("w").alias("pg"))
    pts = spark.createDataFrame([(i, (i * 0.37) % 13, (i * 0.53) % 13) for i in range(400)], "id int, x double, y double")
    fast = spatial_join_points(pts, polys, geom_col="pg")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        slow = spatial_join_points(pts, polys, geom_col="pg", broadcast_budget=0)
        plan = slow._jdf.queryExecution().executedPlan().toString()
        got_slow = sorted((r.id, r.pid) for r in slow.select("id", "pid").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan
    got_fast = sorted((r.id, r.pid) for r in fast.select("id", "pid").collect())
    assert got_fast == got_slow
    # overlap of polygons 1 and 2 gives two rows; points outside all polygons keep one NULL row
    assert len(got_fast) > 400 and any(p is None for _, p in got_fast)
    brute = []
    for i in range(400):
        x, y = (i * 0.37) % 13, (i * 0.53) % 13
        inside = [pid for pid, (a, b, c, d) in ((1, (0, 0, 4, 4)), (2, (3, 3, 8, 8))) if a < x < c and b < y < d]
        tri = 10 < y and y < 10 + 2 * (x - 10) and y < 10 + 2 * (12 - x)
        inside += [3] if tri else []
        brute += [(i, p) for p in inside] or [(i, None)]
    key = lambda t: (t[0], -1 if t[1] is None else t[1])
    assert sorted(got_fast, key=key) == sorted(brute, key=key)


HOLE = "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 4 6, 6 6, 6 4, 4 4))"
TOUCHING = "MULTIPOLYGON(((0 0, 4 0, 4 4, 0 4, 0 0)), ((4 4, 8 4, 8 8, 4 8, 4 4)), ((0 8, 4 8, 4 4, 0 4, 0 8)))"


@pytest.mark.parametrize("outer, inner, want", [
    (HOLE, "POLYGON((4 4, 6 4, 6 6, 4 6, 4 4))", False),                      # fills the hole
    (HOLE, "POLYGON((1 1, 3 1, 3 3, 1 3, 1 1))", True),
    (HOLE, "POLYGON((3 3, 7 3, 7 7, 3 7, 3 3))", False),                      # covers the hole
    (HOLE, HOLE, True),
    ("MULTIPOLYGON(((0 0, 4 0, 4 4, 0 4, 0 0)), ((4 4, 8 4, 8 8, 4 8, 4 4)))", "POLYGON((0 4, 4 4, 4 8, 0 8, 0 4))", False),
    ("MULTIPOLYGON(((0 0, 4 0, 4 4, 0 4, 0 0)), ((4 4, 8 4, 8 8, 4 8, 4 4)))", "POLYGON((5 5, 6 5, 6 6, 5 6, 5 5))", True),
    (TOUCHING, "POLYGON((4 0, 8 0, 8 4, 4 4, 4 0))", False),                  # the gap left of the three
    (HOLE, "MULTIPOLYGON(((1 1, 2 1, 2 2, 1 2, 1 1)), ((4 4, 6 4, 6 6, 4 6, 4 4)))", False),
])
def test_contains_with_holes_and_gaps(spark, outer, inner, want):
    df = spark.range(1).select(F.lit(outer).alias("a"), F.lit(inner).alias("b"))
    df = df.select(geo.geom_from_wkt("a").alias("a"), geo.geom_from_wkt("b").alias("b"))
    assert df.select(geo.st_contains("a", "b")).first()[0] is want


def test_literal_box_of_a_polygon_with_heights(spark):
    assert geo.geom_literal_box(spark, "POLYGON Z((0 0 0, 5 0 0, 0 1 0, 0 0 0))") == (0.0, 0.0, 5.0, 1.0)


def test_an_outlier_shape_costs_four_cells_and_joins_mixed_sizes(spark):
    from odflow.operators.joins import grid_cells, grid_stats, spatial_join_points

    sizes = [0.01] * 30 + [0.3, 5.0, 400.0]
    rows = [(i, (i % 7) * 0.9, (i % 5) * 0.7, s) for i, s in enumerate(sizes)]
    polys = spark.createDataFrame(rows, "pid int, px0 double, py0 double, w double").select(
        "pid", geo.rect("px0", "py0", "px0 + w", "py0 + w").alias("pg"))
    cells = grid_cells(polys, "pg").groupBy("pid").count().collect()
    assert len(cells) == len(sizes) and max(r["count"] for r in cells) <= 4
    assert len(grid_stats(polys, "pg")[0]) == 4
    pts = spark.createDataFrame([(k, (k % 23) * 0.301 - 0.5, (k % 19) * 0.217 - 0.5) for k in range(300)] + [(900, 0.005, 0.005), (901, None, 1.0), (902, 0.005, 0.005)],
                                "k int, x double, y double")
    got = sorted((r.k, -1 if r.pid is None else r.pid) for r in spatial_join_points(pts, polys, geom_col="pg").collect())
    want = []
    for r in pts.collect():
        hit = [i for i, x0, y0, s in rows if r.x is not None and x0 < r.x < x0 + s and y0 < r.y < y0 + s]
        want += [(r.k, i) for i in hit] or [(r.k, -1)]
    assert got == sorted(want)
    shuffled = spatial_join_points(pts, polys, geom_col="pg", broadcast_budget=0).collect()
    assert sorted((r.k, -1 if r.pid is None else r.pid) for r in shuffled) == got
