"""Planar geometry as Catalyst expressions.

A geometry is a struct of nested arrays (multipolygon -> polygon -> ring ->
point), plus two things computed once when the value is built: its
bounding box and a flat edge list with normalised orientation (shells
counter-clockwise, holes clockwise).  Predicates and measures then run
over that one array with higher-order SQL functions (``aggregate``,
``exists``, ``forall``, ``filter``, ``zip_with``), inside the executors'
JVMs, with no Python round trip.

Expressions are written as Spark SQL text and wrapped in one ``F.expr``:
building the same tree through the Column API costs thousands of py4j
calls per expression.  Arguments are SQL expressions (column names are
valid ones).

Conventions (OGC simple features):
* ring 0 of a polygon is its shell, further rings are holes; rings are
  closed (last point equals the first);
* ``st_contains`` excludes the boundary: a point on an edge is not
  contained; a polygon touching the outer edge from inside is contained;
* parts of a multipolygon do not overlap (the even-odd count over all
  edges then decides membership).

A *prepared* geometry carries an index of its edges by height as well (see
``prepare_sql``).  Tests against it look at the edges of one slab, found by
binary search, instead of all; it can stand wherever a geometry can.
"""

from __future__ import annotations

import itertools
import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
POLYGON = T.ArrayType(RING)
EDGE = T.StructType(
    [
        T.StructField("x1", T.DoubleType()), T.StructField("y1", T.DoubleType()),
        T.StructField("x2", T.DoubleType()), T.StructField("y2", T.DoubleType()),
        T.StructField("hole", T.BooleanType()),
    ]
)
GEOM = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("polys", T.ArrayType(POLYGON)),
        T.StructField("edges", T.ArrayType(EDGE)),
        T.StructField("xmin", T.DoubleType()),
        T.StructField("ymin", T.DoubleType()),
        T.StructField("xmax", T.DoubleType()),
        T.StructField("ymax", T.DoubleType()),
    ]
)

PREPARED = T.StructType(
    GEOM.fields
    + [
        T.StructField("at", T.ArrayType(T.DoubleType())),
        T.StructField("first", T.ArrayType(T.IntegerType())),
        T.StructField("members", T.ArrayType(T.IntegerType())),
    ]
)
#: Shapes of so few edges are looked through: one slab.
PLAIN_EDGES = 32
#: Places in the index for each edge, on average, at most about.
PLACES_PER_EDGE = 4

_ids = itertools.count()


def _v(prefix: str = "v") -> str:
    """A fresh lambda variable name."""
    return f"{prefix}_{next(_ids)}"


def _let(value: str, body) -> str:
    """Evaluate ``value`` once and use it (as a variable) in ``body``."""
    v = _v("let")
    return f"transform(array({value}), {v} -> {body(v)})[0]"


def _sql(x: str | Column) -> str:
    if isinstance(x, Column):
        raise TypeError("geometry functions take SQL expressions or column names, not Column objects")
    return str(x)


# ---------------------------------------------------------------- building

def _edges(ring: str) -> str:
    """Edges of a closed ring as ``struct<x1,y1,x2,y2>``."""
    a, b = _v("a"), _v("b")
    n = f"greatest(size({ring}) - 1, 0)"
    return (
        f"zip_with(slice({ring}, 1, {n}), slice({ring}, 2, {n}), ({a}, {b}) -> "
        f"named_struct('x1', {a}.x, 'y1', {a}.y, 'x2', {b}.x, 'y2', {b}.y))"
    )


def _ring_edges_normalised(ring: str, idx: str) -> str:
    acc, e = _v("acc"), _v("e")
    area2 = f"aggregate({_edges(ring)}, 0D, ({acc}, {e}) -> {acc} + {e}.x1 * {e}.y2 - {e}.x2 * {e}.y1)"

    def body(a: str) -> str:
        oriented = f"if(({idx} = 0 AND {a} < 0) OR ({idx} > 0 AND {a} > 0), reverse({ring}), {ring})"
        q = _v("q")
        return (
            f"transform({_edges(oriented)}, {q} -> named_struct('x1', {q}.x1, 'y1', {q}.y1, "
            f"'x2', {q}.x2, 'y2', {q}.y2, 'hole', {idx} > 0))"
        )

    return _let(area2, body)


def make_geom_sql(kind: str, polys: str) -> str:
    """Geometry struct from a kind and ``array<array<array<struct<x,y>>>>``."""
    def build(p: str) -> str:
        poly, r, i, q = _v("poly"), _v("r"), _v("i"), _v("q")
        pts = f"flatten(flatten({p}))"
        edges = (
            f"flatten(flatten(transform({p}, {poly} -> transform({poly}, ({r}, {i}) -> "
            f"{_ring_edges_normalised(r, i)}))))"
        )
        return (
            f"named_struct('kind', {kind}, 'polys', {p}, 'edges', {edges}, "
            f"'xmin', array_min(transform({pts}, {q} -> {q}.x)), 'ymin', array_min(transform({pts}, {q} -> {q}.y)), "
            f"'xmax', array_max(transform({pts}, {q} -> {q}.x)), 'ymax', array_max(transform({pts}, {q} -> {q}.y)))"
        )

    return _let(polys, build)


def make_geom(kind: str, polys: str) -> Column:
    return F.expr(make_geom_sql(_sql(kind), _sql(polys)))


def _pt(x: str, y: str) -> str:
    return f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE))"


def rect_sql(xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    ring = f"array({_pt(xmin, ymin)}, {_pt(xmax, ymin)}, {_pt(xmax, ymax)}, {_pt(xmin, ymax)}, {_pt(xmin, ymin)})"
    return make_geom_sql("'Polygon'", f"array(array({ring}))")


def rect(xmin: str, ymin: str, xmax: str, ymax: str) -> Column:
    """Axis-aligned rectangle as a one-ring Polygon (counter-clockwise)."""
    return F.expr(rect_sql(_sql(xmin), _sql(ymin), _sql(xmax), _sql(ymax)))


# ---------------------------------------------------------------- edge index

def last_not_above(values: str, v: str, last: str) -> str:
    """Binary search: the last of the places 0 to ``last`` of sorted values
    that is not above ``v``; 0 if there is none."""
    a, k = _v("a"), _v("k")
    step = _let(
        f"CAST(({a}.lo + {a}.hi + 1) DIV 2 AS INT)",
        lambda m: f"if(get({values}, {m}) <= {v}, named_struct('lo', {m}, 'hi', {a}.hi), named_struct('lo', {a}.lo, 'hi', {m} - 1))",
    )
    steps = f"CAST(ceil(log2(greatest({last} + 1, 2))) AS INT)"
    return (
        f"aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', CAST({last} AS INT)), "
        f"({a}, {k}) -> if({a}.lo >= {a}.hi, {a}, {step}), {a} -> {a}.lo)"
    )


def prepare_sql(geom: str) -> str:
    """The geometry with its edges indexed by height.

    The plane is cut into slabs at the heights in ``at``, heights of vertices.
    ``members[first[k]]`` up to ``members[first[k + 1] - 1]`` are the numbers
    of the edges that touch slab k, closed at both ends.  Slabs end at every
    vertex height, or at every second, third, ... where long edges would
    otherwise take more than about PLACES_PER_EDGE places each, so the index
    stays proportional to the shape.  Built by sorting and binary searches.
    """
    def build(g: str) -> str:
        e, r, i, k, q = (_v(x) for x in "erikq")
        n = f"size({g}.edges)"
        low, high = f"least({e}.y1, {e}.y2)", f"greatest({e}.y1, {e}.y2)"

        def with_stride(ys: str) -> str:
            last = f"greatest(size({ys}) - 1, 0)"
            spans = (
                f"aggregate({g}.edges, 0L, ({r}, {e}) -> {r} + 1 + {last_not_above(ys, high, last)} - {last_not_above(ys, low, last)})"
            )
            stride = f"if({n} <= {PLAIN_EDGES}, greatest(size({ys}), 1), greatest(1, CAST(ceil({spans} / ({PLACES_PER_EDGE}D * {n})) AS INT)))"
            return _let(stride, lambda t: _let(
                f"concat(filter({ys}, ({q}, {i}) -> {i} % {t} = 0 AND {i} < size({ys}) - 1), slice({ys}, greatest(size({ys}), 1), 1))",
                with_slabs))

        def with_slabs(at: str) -> str:
            e2, i2, k2 = _v("e"), _v("i"), _v("k")
            slabs = f"greatest(size({at}) - 1, 1)"
            lo = last_not_above(at, f"least({e2}.y1, {e2}.y2)", f"{slabs} - 1")
            hi = last_not_above(at, f"greatest({e2}.y1, {e2}.y2)", f"{slabs} - 1")
            places = (
                f"sort_array(flatten(transform({g}.edges, ({e2}, {i2}) -> "
                f"transform(sequence({lo}, {hi}), {k2} -> CAST({k2} AS BIGINT) * {n} + {i2}))))"
            )

            def finish(p: str) -> str:
                k3, m = _v("k"), _v("m")
                # places of slabs before k: one more than the last of them, found among halves so that none is equal
                before = _let(
                    last_not_above(p, f"CAST({k3} AS BIGINT) * {n} - 1", f"greatest(size({p}) - 1, 0)"),
                    lambda x: f"if(size({p}) > 0 AND get({p}, {x}) < CAST({k3} AS BIGINT) * {n}, {x} + 1, 0)",
                )
                fields = ", ".join(f"'{f.name}', {g}.{f.name}" for f in GEOM.fields)
                return (
                    f"named_struct({fields}, 'at', {at}, 'first', transform(sequence(0, {slabs}), {k3} -> {before}), "
                    f"'members', transform({p}, {m} -> CAST({m} % greatest({n}, 1) AS INT)))"
                )

            return _let(places, finish)

        heights = f"sort_array(array_distinct(flatten(transform({g}.edges, {k} -> array({k}.y1, {k}.y2)))))"
        return f"CASE WHEN {g}.edges IS NOT NULL THEN {_let(heights, with_stride)} END"

    return _let(geom, build)


def prepare(geom: str) -> Column:
    return F.expr(prepare_sql(_sql(geom)))


def plain(geom: str) -> Column:
    """The geometry in a prepared one."""
    g = _sql(geom)
    fields = ", ".join(f"'{f.name}', {g}.{f.name}" for f in GEOM.fields)
    return F.expr(f"CASE WHEN {g}.edges IS NOT NULL THEN named_struct({fields}) END")


def _slab(p: str, y: str) -> str:
    """Number of the slab of a prepared geometry that a height lies in (the
    first or last one for heights outside)."""
    return last_not_above(f"{p}.at", y, f"greatest(size({p}.at) - 2, 0)")


def _slab_members(p: str, y0: str, y1: str) -> str:
    """Numbers of the edges in the slabs from ``y0`` to ``y1``."""
    def members(a: str, b: str) -> str:
        return f"slice({p}.members, get({p}.first, {a}) + 1, get({p}.first, {b} + 1) - get({p}.first, {a}))"

    if y0 == y1:
        return _let(_slab(p, y0), lambda a: members(a, a))
    return _let(_slab(p, y0), lambda a: _let(_slab(p, y1), lambda b: members(a, b)))


def edges_at(prepared: str, y: str) -> Column:
    """How many edges a test of a point at height ``y`` looks at."""
    p = _sql(prepared)
    return F.expr(f"size({_slab_members(p, _sql(y), _sql(y))})")


# ---------------------------------------------------------------- parsing

def geom_from_wkt_sql(wkt: str) -> str:
    """``ST_GeomFromText`` for POLYGON and MULTIPOLYGON (holes included).

    String functions only: strip the tag and the outer parentheses, split
    into polygons, rings, points, coordinates.  A malformed number fails
    the cast (ANSI), as a bad literal should.
    """
    def parse(s: str) -> str:
        body = (
            f"regexp_replace(regexp_replace({s}, '^(MULTI)?POLYGON\\\\s*(ZM|Z|M)?\\\\s*', ''), "
            f"'^\\\\(+\\\\s*|\\\\s*\\\\)+$', '')"
        )
        p, r, t = _v("p"), _v("r"), _v("t")
        multi = f"startswith({s}, 'MULTIPOLYGON')"
        texts = f"if({multi}, split({body}, '\\\\)\\\\s*\\\\)\\\\s*,\\\\s*\\\\(\\\\s*\\\\('), array({body}))"
        point = _let(
            f"split(trim({t}), '\\\\s+')",
            lambda c: f"named_struct('x', CAST({c}[0] AS DOUBLE), 'y', CAST({c}[1] AS DOUBLE))",
        )
        polys = (
            f"transform({texts}, {p} -> transform(split({p}, '\\\\)\\\\s*,\\\\s*\\\\('), {r} -> "
            f"transform(split(trim({r}), '\\\\s*,\\\\s*'), {t} -> {point})))"
        )
        return make_geom_sql(f"if({multi}, 'MultiPolygon', 'Polygon')", polys)

    return _let(f"upper(trim({wkt}))", parse)


def geom_from_wkt(wkt: str) -> Column:
    return F.expr(geom_from_wkt_sql(_sql(wkt)))


def sql_string(text: str) -> str:
    """``text`` as a Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_LITERALS: dict[tuple[str, str], str] = {}


def geom_literal_sql(spark, wkt: str) -> str:
    """A WKT parameter as one folded, prepared geometry literal (SQL text).

    Parsed and indexed once per session by a one-row job and embedded as a
    JSON constant, so plans that test it against every row carry a constant,
    not the parser.
    """
    key = (spark.sparkContext.applicationId, wkt)
    if key not in _LITERALS:
        txt = spark.range(1).select(F.to_json(F.expr(prepare_sql(geom_from_wkt_sql(sql_string(wkt)))))).first()[0]
        _LITERALS[key] = txt
    return f"from_json({sql_string(_LITERALS[key])}, {sql_string(PREPARED.simpleString())})"


def geom_literal_box(spark, wkt: str) -> tuple[float, float, float, float]:
    """(xmin, ymin, xmax, ymax) of a WKT parameter, from its parsed literal."""
    geom_literal_sql(spark, wkt)
    g = json.loads(_LITERALS[(spark.sparkContext.applicationId, wkt)])
    return g["xmin"], g["ymin"], g["xmax"], g["ymax"]


def geom_literal(spark, wkt: str) -> Column:
    return F.expr(geom_literal_sql(spark, wkt))


def geom_from_geojson_sql(gtype: str, coordinates_json: str) -> str:
    """Geometry from a GeoJSON ``type`` and the raw JSON text of ``coordinates``.

    Readers declare ``coordinates`` as a string so one schema fits Polygon
    and MultiPolygon features; the text is parsed here per type.
    """
    def ring_of(arr: str) -> str:
        q = _v("q")
        return f"transform({arr}, {q} -> named_struct('x', {q}[0], 'y', {q}[1]))"

    r1, p2, r2 = _v("r"), _v("p"), _v("r")
    poly = f"from_json({coordinates_json}, 'array<array<array<double>>>')"
    multi = f"from_json({coordinates_json}, 'array<array<array<array<double>>>>')"
    polys = (
        f"CASE WHEN {gtype} = 'Polygon' THEN array(transform({poly}, {r1} -> {ring_of(r1)})) "
        f"WHEN {gtype} = 'MultiPolygon' THEN transform({multi}, {p2} -> transform({p2}, {r2} -> {ring_of(r2)})) END"
    )
    return make_geom_sql(gtype, polys)


def geom_from_geojson(gtype: str, coordinates_json: str) -> Column:
    return F.expr(geom_from_geojson_sql(_sql(gtype), _sql(coordinates_json)))


def st_as_geojson_sql(g: str) -> str:
    def arrays(p: str) -> str:
        r, q = _v("r"), _v("q")
        return f"transform({p}, {r} -> transform({r}, {q} -> array({q}.x, {q}.y)))"

    p = _v("p")
    return (
        f"CASE WHEN {g}.kind = 'Polygon' "
        f"THEN to_json(named_struct('type', 'Polygon', 'coordinates', {arrays(f'{g}.polys[0]')})) "
        f"ELSE to_json(named_struct('type', 'MultiPolygon', 'coordinates', transform({g}.polys, {p} -> {arrays(p)}))) END"
    )


def st_as_geojson(geom: str) -> Column:
    """``ST_AsGeoJSON``: ``{"type":...,"coordinates":...}`` text."""
    return F.expr(st_as_geojson_sql(_sql(geom)))


# ---------------------------------------------------------------- predicates

def _cross(e: str, px: str, py: str) -> str:
    """Twice the signed area of (edge start, edge end, point)."""
    return f"(({e}.x2 - {e}.x1) * (({py}) - {e}.y1) - (({px}) - {e}.x1) * ({e}.y2 - {e}.y1))"


def _on_segment(e: str, px: str, py: str) -> str:
    return (
        f"({_cross(e, px, py)} = 0 AND ({px}) >= least({e}.x1, {e}.x2) AND ({px}) <= greatest({e}.x1, {e}.x2) "
        f"AND ({py}) >= least({e}.y1, {e}.y2) AND ({py}) <= greatest({e}.y1, {e}.y2))"
    )


def _crosses_ray(e: str, px: str, py: str) -> str:
    """Does the ray from (px, py) towards +x cross edge ``e`` (half-open rule)?"""
    c = _cross(e, px, py)
    return (
        f"((({e}.y1 > ({py})) != ({e}.y2 > ({py}))) AND "
        f"(CASE WHEN {e}.y2 > {e}.y1 THEN {c} > 0 ELSE {c} < 0 END))"
    )


def _in_bbox(g: str, px: str, py: str) -> str:
    return f"(({px}) >= {g}.xmin AND ({px}) <= {g}.xmax AND ({py}) >= {g}.ymin AND ({py}) <= {g}.ymax)"


def _locate(p: str, px: str, py: str) -> str:
    """One pass over the edges in the point's slab: ``struct<n: ray crossings, b: on boundary>``."""
    acc, i = _v("acc"), _v("i")

    def step(e: str) -> str:
        return (
            f"named_struct('n', {acc}.n + CASE WHEN {_crosses_ray(e, px, py)} THEN 1 ELSE 0 END, "
            f"'b', {acc}.b OR {_on_segment(e, px, py)})"
        )

    return (
        f"aggregate({_slab_members(p, py, py)}, named_struct('n', 0, 'b', false), "
        f"({acc}, {i}) -> {_let(f'get({p}.edges, {i})', step)})"
    )


def _contains_point(g: str, px: str, py: str) -> str:
    return f"({_in_bbox(g, px, py)} AND {_let(_locate(g, px, py), lambda r: f'({r}.n % 2 = 1 AND NOT {r}.b)')})"


def _covers_point(g: str, px: str, py: str) -> str:
    return f"({_in_bbox(g, px, py)} AND {_let(_locate(g, px, py), lambda r: f'({r}.n % 2 = 1 OR {r}.b)')})"


def _as_prepared(geom: str, prepared: bool) -> str:
    return geom if prepared else prepare_sql(geom)


def st_contains_point_sql(geom: str, px: str, py: str, prepared: bool = False) -> str:
    return _let(_as_prepared(geom, prepared), lambda g: _contains_point(g, px, py))


def st_contains_point(geom: str, px: str, py: str, prepared: bool = False) -> Column:
    """``ST_Contains(polygon, point)``: interior only, holes excluded.

    ``prepared``: the geometry is a prepared one, as literals are; otherwise
    it is prepared for this row, which pays for itself only with several
    points a row.
    """
    return F.expr(st_contains_point_sql(_sql(geom), _sql(px), _sql(py), prepared))


def st_covers_point(geom: str, px: str, py: str, prepared: bool = False) -> Column:
    """Interior or boundary."""
    return F.expr(_let(_as_prepared(_sql(geom), prepared), lambda g: _covers_point(g, _sql(px), _sql(py))))


def _orient(ax, ay, bx, by, cx, cy) -> str:
    return f"(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


def _proper_cross(e: str, f: str) -> str:
    """Segments meet at one point interior to both."""
    o1 = _orient(f"{e}.x1", f"{e}.y1", f"{e}.x2", f"{e}.y2", f"{f}.x1", f"{f}.y1")
    o2 = _orient(f"{e}.x1", f"{e}.y1", f"{e}.x2", f"{e}.y2", f"{f}.x2", f"{f}.y2")
    o3 = _orient(f"{f}.x1", f"{f}.y1", f"{f}.x2", f"{f}.y2", f"{e}.x1", f"{e}.y1")
    o4 = _orient(f"{f}.x1", f"{f}.y1", f"{f}.x2", f"{f}.y2", f"{e}.x2", f"{e}.y2")
    return f"({o1} * {o2} < 0 AND {o3} * {o4} < 0)"


def _edges_near(o: str, e: str) -> str:
    """The edges of ``o`` in the slabs that ``e`` passes whose widths overlap with it."""
    f, i = _v("f"), _v("i")
    numbers = _slab_members(o, f"least({e}.y1, {e}.y2)", f"greatest({e}.y1, {e}.y2)")
    return (
        f"filter(transform(array_distinct({numbers}), {i} -> get({o}.edges, {i})), {f} -> "
        f"greatest({f}.x1, {f}.x2) >= least({e}.x1, {e}.x2) AND least({f}.x1, {f}.x2) <= greatest({e}.x1, {e}.x2))"
    )


def edge_meetings(outer: str, inner: str) -> Column:
    """How many edges of ``outer`` (prepared) the edges of ``inner`` are compared with, in all."""
    o, n, e = _sql(outer), _v("n"), _v("e")
    return F.expr(f"aggregate({_sql(inner)}.edges, 0L, ({n}, {e}) -> {n} + size({_edges_near(o, e)}))")


def _edge_inside(o: str, e: str) -> str:
    """Edge ``e`` of the inner shape lies in ``o`` (interior or boundary).

    Start vertex covered; no proper crossing with an edge of ``o``; the edge
    is cut at every vertex of ``o`` lying on it and each piece's midpoint
    is covered.  Only the edges of ``o`` near ``e`` are looked at.
    """
    return _let(_edges_near(o, e), lambda near: _edge_inside_near(o, e, near))


def _edge_inside_near(o: str, e: str, near: str) -> str:
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    len2 = f"({dx} * {dx} + {dy} * {dy})"
    f1, f2, f3, k = _v("f"), _v("f"), _v("f"), _v("k")
    touching = f"filter({near}, {f1} -> {_on_segment(e, f'{f1}.x1', f'{f1}.y1')})"
    ts = (
        f"transform({touching}, {f2} -> CASE WHEN {len2} > 0 "
        f"THEN (({f2}.x1 - {e}.x1) * {dx} + ({f2}.y1 - {e}.y1) * {dy}) / {len2} ELSE 0D END)"
    )
    cuts = f"array_sort(concat(array(0D, 1D), {ts}))"

    def pieces(c: str) -> str:
        mid = _let(
            f"named_struct('x', {e}.x1 + (({c}[{k} - 1] + {c}[{k}]) / 2) * {dx}, "
            f"'y', {e}.y1 + (({c}[{k} - 1] + {c}[{k}]) / 2) * {dy})",
            lambda m: _covers_point(o, f"{m}.x", f"{m}.y"),
        )
        return f"forall(sequence(1, size({c}) - 1), {k} -> {mid})"

    return (
        f"({_covers_point(o, f'{e}.x1', f'{e}.y1')} "
        f"AND NOT exists({near}, {f3} -> {_proper_cross(e, f3)}) "
        f"AND {_let(cuts, pieces)})"
    )


def _inner_point(poly: str, use) -> str:
    """``use(point)`` for a point inside one polygon (array of rings): the
    middle of the first chord that a line between its two lowest vertex
    heights cuts.  A polygon without area has no such line: true."""
    r, q, r2, k, c = (_v(x) for x in "rqrkc")

    def cut(y: str) -> str:
        x1, y1, x2, y2 = f"{r2}[{k} - 1].x", f"{r2}[{k} - 1].y", f"{r2}[{k}].x", f"{r2}[{k}].y"
        at = f"CASE WHEN ({y1} > {y}) != ({y2} > {y}) THEN {x1} + ({x2} - {x1}) * ({y} - {y1}) / ({y2} - {y1}) END"
        return (
            f"array_sort(filter(flatten(transform({poly}, {r2} -> transform(sequence(1, greatest(size({r2}) - 1, 1)), {k} -> {at}))), "
            f"{c} -> {c} IS NOT NULL))"
        )

    def middle(ys: str) -> str:
        return _let(f"({ys}[0] + {ys}[1]) / 2", lambda y: _let(
            cut(y), lambda xs: _let(f"named_struct('x', ({xs}[0] + {xs}[1]) / 2, 'y', {y})", use)))

    heights = f"array_sort(array_distinct(flatten(transform({poly}, {r} -> transform({r}, {q} -> {q}.y)))))"
    return _let(heights, lambda ys: f"CASE WHEN size({ys}) < 2 THEN true ELSE {middle(ys)} END")


def st_contains_sql(outer: str, inner: str, prepared: bool = False) -> str:
    def test(o: str, i: str) -> str:
        part = _v("part")
        e, f, h = _v("e"), _v("f"), _v("h")

        def no_hole_inside(holes: str, p: str) -> str:
            return (
                f"forall({holes}, {h} -> NOT {_contains_point(p, f'{h}.x1', f'{h}.y1')} "
                f"AND NOT {_contains_point(p, f'({h}.x1 + {h}.x2) / 2', f'({h}.y1 + {h}.y2) / 2')})"
            )

        bbox = f"({i}.xmin >= {o}.xmin AND {i}.xmax <= {o}.xmax AND {i}.ymin >= {o}.ymin AND {i}.ymax <= {o}.ymax)"
        edges_ok = f"forall({i}.edges, {e} -> {_edge_inside(o, e)})"
        # the inner shape is indexed only where a hole's edges are tested against it
        holes_ok = _let(f"filter({o}.edges, {f} -> {f}.hole)", lambda hs: f"(size({hs}) = 0 OR {_let(prepare_sql(i), lambda p: no_hole_inside(hs, p))})")
        # edges may all run along the boundary of a hole or a gap that the shape fills
        parts_ok = f"forall({i}.polys, {part} -> {_inner_point(part, lambda m: _covers_point(o, f'{m}.x', f'{m}.y'))})"
        return f"({bbox} AND {edges_ok} AND {holes_ok} AND {parts_ok})"

    return _let(_as_prepared(outer, prepared), lambda o: _let(inner, lambda i: test(o, i)))


def st_contains(outer_geom: str, inner_geom: str, prepared: bool = False) -> Column:
    """``ST_Contains(polygon, polygon)``: ``inner`` lies in ``outer``, touching allowed.

    Tests: bounding boxes; every inner edge inside (``_edge_inside``); no
    hole of ``outer`` has a vertex or an edge midpoint strictly inside
    ``inner``; a point inside each part of ``inner`` is covered.  An inner edge
    meets only the outer edges of the slabs it passes.  ``prepared``: the outer
    geometry is a prepared one, as literals are.
    """
    return F.expr(st_contains_sql(_sql(outer_geom), _sql(inner_geom), prepared))


# ---------------------------------------------------------------- measures

def st_centroid_sql(g: str) -> str:
    acc, e = _v("acc"), _v("e")

    def step(t: str) -> str:
        return (
            f"named_struct('a', {acc}.a + {t}.c, 'mx', {acc}.mx + ({e}.x1 + {e}.x2) * {t}.c, "
            f"'my', {acc}.my + ({e}.y1 + {e}.y2) * {t}.c, 'l', {acc}.l + {t}.ln, "
            f"'lx', {acc}.lx + {t}.ln * ({e}.x1 + {e}.x2) / 2, 'ly', {acc}.ly + {t}.ln * ({e}.y1 + {e}.y2) / 2, "
            f"'n', {acc}.n + 1, 'sx', {acc}.sx + {e}.x1, 'sy', {acc}.sy + {e}.y1)"
        )

    terms = f"named_struct('c', {e}.x1 * {e}.y2 - {e}.x2 * {e}.y1, 'ln', hypot({e}.x2 - {e}.x1, {e}.y2 - {e}.y1))"
    init = "named_struct('a', 0D, 'mx', 0D, 'my', 0D, 'l', 0D, 'lx', 0D, 'ly', 0D, 'n', 0, 'sx', 0D, 'sy', 0D)"
    s = _v("s")
    finish = (
        f"{s} -> named_struct("
        f"'x', CASE WHEN {s}.a != 0 THEN {s}.mx / (3 * {s}.a) WHEN {s}.l != 0 THEN {s}.lx / {s}.l "
        f"ELSE try_divide({s}.sx, {s}.n) END, "
        f"'y', CASE WHEN {s}.a != 0 THEN {s}.my / (3 * {s}.a) WHEN {s}.l != 0 THEN {s}.ly / {s}.l "
        f"ELSE try_divide({s}.sy, {s}.n) END)"
    )
    return f"aggregate({g}.edges, {init}, ({acc}, {e}) -> {_let(terms, step)}, {finish})"


def st_centroid(geom: str) -> Column:
    """Area-weighted centroid as ``struct<x,y>`` (``ST_Centroid``).

    Edges carry normalised orientation, so one shoelace pass over all of
    them gives area and moments with holes subtracted.  Zero area falls
    back to the length-weighted mean of edge midpoints, then to the mean of
    the vertices.
    """
    return F.expr(st_centroid_sql(_sql(geom)))


def st_area(geom: str) -> Column:
    """Planar area (holes subtracted)."""
    acc, e = _v("acc"), _v("e")
    g = _sql(geom)
    return F.expr(f"aggregate({g}.edges, 0D, ({acc}, {e}) -> {acc} + {e}.x1 * {e}.y2 - {e}.x2 * {e}.y1) / 2")


def bbox_within(geom: str, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Plain comparisons on the stored box: these reach the Parquet scan as pushed filters."""
    g = F.col(geom)
    return (g["xmin"] >= xmin) & (g["ymin"] >= ymin) & (g["xmax"] <= xmax) & (g["ymax"] <= ymax)
