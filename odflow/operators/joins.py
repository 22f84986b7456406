"""Join operators: size-checked broadcast, code resolution, spatial joins."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.functions import geo
from odflow.session import stored

# Broadcast budget for dimension tables (bytes, estimated from the schema).
BROADCAST_BUDGET_BYTES = 64 * 1024 * 1024


def _width(dt: T.DataType) -> int | None:
    """Estimated bytes of a value; None where only a measurement can tell (arrays, maps)."""
    if isinstance(dt, T.StructType):
        parts = [_width(f.dataType) for f in dt.fields]
        return None if None in parts else sum(parts)
    if isinstance(dt, (T.ArrayType, T.MapType)):
        return None
    if isinstance(dt, T.StringType):
        return 64
    if isinstance(dt, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(dt, T.BooleanType):
        return 1
    return 4


def row_width(df: DataFrame) -> int | None:
    w = _width(df.schema)
    return None if w is None else max(8, w)


_ROWS_LOCK = threading.Lock()
_ROWS: dict[tuple, int] = {}


def dim_rows(df: DataFrame, cap: int | None = None) -> int:
    """Row count of a dimension, cached per plan and input files.

    Meant for scans of stored tables (a Parquet count reads only footers)
    and small derived frames.  The key includes the input file list, so a
    rewritten table is counted again.  With ``cap`` the count stops after
    ``cap + 1`` rows.
    """
    try:
        key = (df.semanticHash(), tuple(sorted(df.inputFiles())), cap)
    except Exception:  # noqa: BLE001
        key = None
    if key is not None:
        with _ROWS_LOCK:
            if key in _ROWS:
                return _ROWS[key]
    n = (df.limit(cap + 1) if cap is not None else df).count()
    if key is not None:
        with _ROWS_LOCK:
            _ROWS[key] = n
    return n


_FANS: dict[tuple, int] = {}


def fan_out(df: DataFrame, col: str) -> int:
    """Most rows that one value of ``col`` has: what a join with the stored
    table ``df`` can multiply rows by.  Cached like ``dim_rows``."""
    try:
        key = (df.semanticHash(), tuple(sorted(df.inputFiles())), col)
    except Exception:  # noqa: BLE001
        key = None
    if key is not None:
        with _ROWS_LOCK:
            if key in _FANS:
                return _FANS[key]
    n = df.groupBy(col).count().agg(F.max("count")).first()[0] or 0
    if key is not None:
        with _ROWS_LOCK:
            _FANS[key] = n
    return n


_RANGES: dict[tuple, list[tuple[int, int]]] = {}


def key_ranges(keys: DataFrame, col: str, source: DataFrame, *what, most: int = 16) -> list[tuple[int, int]]:
    """The values of an integer column as at most ``most`` ranges that hold
    them all, cut at the widest gaps.

    ``keys`` is a list of places, at most one value for each zone, and is
    collected; cached by ``source``, the stored table that it comes from, its
    files, and ``what`` was asked of it.
    """
    try:
        cached = (source.semanticHash(), tuple(sorted(source.inputFiles())), col, most, *what)
    except Exception:  # noqa: BLE001
        cached = None
    if cached is not None:
        with _ROWS_LOCK:
            if cached in _RANGES:
                return _RANGES[cached]
    values = sorted({r[0] for r in keys.select(col).distinct().collect() if r[0] is not None})
    gaps = sorted(range(1, len(values)), key=lambda i: values[i - 1] - values[i])[:most - 1]
    cuts = [0, *sorted(g for g in gaps if values[g] - values[g - 1] > 1), len(values)]
    out = [(values[a], values[b - 1]) for a, b in zip(cuts, cuts[1:]) if a < b]
    if cached is not None:
        with _ROWS_LOCK:
            _RANGES[cached] = out
    return out


def within(col: str, ranges: list[tuple[int, int]]) -> Column:
    """Whether a column lies in one of the ranges: plain comparisons with
    literals, which reach the Parquet scan and skip row groups."""
    return reduce(Column.__or__, [F.col(col).between(a, b) for a, b in ranges], F.lit(False))


def bounded_broadcast(df: DataFrame, bound: DataFrame | int | None = None,
                      budget_bytes: int = BROADCAST_BUDGET_BYTES, known_rows: int | None = None,
                      known_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` only when its size is proven within the budget.

    The proof is ``known_bytes``, a measured size, or a row bound times a
    row width from the schema.  Frames with arrays (geometries) have no
    width that a schema could tell: without a measurement they get no hint.  The row
    bound is ``known_rows``, or the row count of ``bound`` -- a cheap source
    frame that ``df`` is derived from by filters, projections, joins to
    unique keys or grouping (so it cannot have more rows), e.g. the place
    catalogue for every list of places -- or, without either, the count of
    ``df`` itself stopped at the budget.  Over budget the frame is returned
    unhinted and Spark plans a shuffle join (AQE may still convert it at
    runtime from measured sizes).
    """
    if known_bytes is not None:
        return F.broadcast(df) if known_bytes <= budget_bytes else df
    width = row_width(df)
    if width is None:
        return df
    max_rows = max(1, budget_bytes // width)
    if known_rows is not None:
        n = known_rows
    elif isinstance(bound, int):
        n = bound
    elif bound is not None:
        n = dim_rows(bound)
    else:
        n = dim_rows(df, cap=max_rows)
    return F.broadcast(df) if n <= max_rows else df


def resolve_codes(
    facts: DataFrame,
    codes: DataFrame,
    fact_col: str,
    code_col: str,
    id_col: str,
    out_col: str,
) -> DataFrame:
    """Inner join facts to distinct (code, official id) pairs; drop unmapped.

    ``codes`` is the relations dimension; it is deduplicated on the text
    pair first (one code with two official ids keeps both, so the fact row
    is repeated), then ids that do not parse (``'NA'``) are removed before
    the join.  The dimension is broadcast after a size check.
    """
    from odflow.functions.scalar import try_int

    dim = (
        codes.select(F.col(code_col).alias("_code"), F.col(id_col).alias("_ine"))
        .distinct()
        .select("_code", try_int("_ine").alias(out_col))
        .filter(F.col(out_col).isNotNull())
    )
    dim = dim.withColumnRenamed("_code", f"_code_{out_col}")
    joined = facts.join(bounded_broadcast(dim), facts[fact_col] == dim[f"_code_{out_col}"], "inner")
    return joined.drop(f"_code_{out_col}")


# Points of one cell that a task may get before the cell is split, and the most cells that are.
HOT_ROWS = 1_000_000
MAX_HOT_CELLS = 10_000
#: Halvings of a hot cell's side, at most.
QUAD_DEPTH = 6

_GRIDS: dict[tuple, tuple[list[int], int]] = {}
_MIN_LEVEL = -60


def _grid_level(geom_col: str):
    """The least power of two that a shape's box fits in, as its exponent: on
    a grid of that size the box overlaps four cells at most."""
    g = F.col(geom_col)
    extent = F.greatest(g["xmax"] - g["xmin"], g["ymax"] - g["ymin"])
    return F.greatest(F.coalesce(F.ceil(F.log2(F.when(extent > 0, extent))), F.lit(_MIN_LEVEL)), F.lit(_MIN_LEVEL)).cast("int")


def grid_stats(polygons: DataFrame, geom_col: str = "geom") -> tuple[list[int], int]:
    """Grid levels of the polygons, and the bytes of their cells: up to four
    rows each with their points and edges, counted.  One small aggregate,
    cached per plan and input files like ``dim_rows``."""
    try:
        key = (polygons.semanticHash(), tuple(sorted(polygons.inputFiles())), geom_col)
    except Exception:  # noqa: BLE001
        key = None
    if key is not None:
        with _ROWS_LOCK:
            if key in _GRIDS:
                return _GRIDS[key]
    row = polygons.agg(
        F.collect_set(_grid_level(geom_col)).alias("levels"),
        F.coalesce(F.sum(F.lit(1024) + F.lit(136) * F.size(F.col(geom_col)["edges"])), F.lit(0)).alias("bytes"),   # with their index
    ).first()
    out = (sorted(row["levels"]), 4 * int(row["bytes"]))
    if key is not None:
        with _ROWS_LOCK:
            _GRIDS[key] = out
    return out


def grid_cells(polygons: DataFrame, geom_col: str = "geom") -> DataFrame:
    """Every polygon, prepared, once per cell (_level, _gx, _gy) that its box
    overlaps on the grid of its own level: at most four rows, however large or
    small."""
    g = F.col(geom_col)
    df = polygons.withColumn("_level", _grid_level(geom_col)).withColumn(geom_col, geo.prepare(geom_col))
    s = F.pow(F.lit(2.0), F.col("_level"))
    return (
        df.withColumn("_gx", F.explode(F.sequence(F.floor(g["xmin"] / s), F.floor(g["xmax"] / s))))
        .withColumn("_gy", F.explode(F.sequence(F.floor(g["ymin"] / s), F.floor(g["ymax"] / s))))
    )


def _cell(level, x: str, y: str):
    s = F.pow(F.lit(2.0), level)
    return F.floor(F.col(x) / s), F.floor(F.col(y) / s)


def spatial_join_points(
    points: DataFrame,
    polygons: DataFrame,
    x: str = "x",
    y: str = "y",
    geom_col: str = "geom",
    how: str = "left",
    broadcast_budget: int = BROADCAST_BUDGET_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Points joined to the polygons that contain them (``ST_Contains(poly, pt)``).

    An equi-join on grid cells plus the exact test in the same join
    condition.  Every polygon has a grid level from its own extent and at
    most four cells there, so one outlier costs no more than any other shape;
    a point has one cell on each level that occurs.  With ``how='left'`` a
    point in no polygon keeps one row with NULL polygon columns, a point in
    two overlapping polygons gets two rows.  Cells, with the edge index of
    their polygons, are broadcast when their measured size is within the
    budget; with shapes of several levels each distinct position is then
    looked up once on every level, and the points are joined to what was found.
    Otherwise both sides shuffle on the cell, and cells of more than
    ``hot_rows`` points on the parts of a quadtree (``hot_cells``).
    """
    levels, n_bytes = grid_stats(polygons, geom_col)
    if n_bytes > broadcast_budget:
        return _shuffled_spatial_join(points, polygons, levels, x, y, geom_col, how, hot_rows)
    cells = bounded_broadcast(grid_cells(polygons, geom_col), known_bytes=n_bytes, budget_bytes=broadcast_budget)

    # Column names of the two sides are distinct, so the exact test can
    # name them directly.
    def cond(pts):
        return (
            (pts["_pl"] == cells["_level"]) & (pts["_px"] == cells["_gx"]) & (pts["_py"] == cells["_gy"])
            & geo.st_contains_point(geom_col, x, y, prepared=True)
        )

    helpers = ("_pl", "_px", "_py", "_level", "_gx", "_gy")
    if len(levels) <= 1:
        px, py = _cell(F.lit(float(levels[0] if levels else 0)), x, y)
        pts = points.withColumns({"_pl": F.lit(levels[0] if levels else 0), "_px": px, "_py": py})
        return pts.join(cells, cond(pts), how).drop(*helpers).withColumn(geom_col, geo.plain(geom_col))
    places = points.select(x, y).distinct().withColumn("_pl", F.explode(F.array(*[F.lit(v) for v in levels])))
    px, py = _cell(F.col("_pl"), x, y)
    places = places.withColumns({"_px": px, "_py": py})
    found = places.join(cells, cond(places), "inner").drop(*helpers).withColumn(geom_col, geo.plain(geom_col))
    found = found.withColumnsRenamed({x: "_fx", y: "_fy"})
    return points.join(found, (points[x] == found["_fx"]) & (points[y] == found["_fy"]), how).drop("_fx", "_fy")


def _fine_cell(x: str, y: str):
    """Number of a point's part of its cell (_pl, _px, _py), out of 4 to the
    power QUAD_DEPTH: bits of its column and row by turns."""
    part = F.pow(F.lit(2.0), F.col("_pl")) / 2.0**QUAD_DEPTH
    code = F.lit(0).cast("long")
    for at, (place, corner) in enumerate(((x, "_px"), (y, "_py"))):
        i = F.floor(F.col(place) / part) - F.col(corner) * 2**QUAD_DEPTH
        for bit in range(QUAD_DEPTH):
            code = code + F.shiftleft(F.shiftright(i, bit).bitwiseAND(F.lit(1)), 2 * bit + at)
    return code


def quadtree(counts: dict[int, int], limit: int) -> Iterator[tuple[int, int, int]]:
    """(first part, depth, pieces) of the squares that a cell is split into:
    squares of at most ``limit`` points, and at the last depth those of more,
    in so many pieces; empty squares are left out."""
    def split(parts: list[tuple[int, int]], first: int, depth: int):
        total = sum(n for _, n in parts)
        if total <= limit or depth == QUAD_DEPTH:
            yield first, depth, -(-total // limit)
            return
        width = 4 ** (QUAD_DEPTH - depth - 1)
        for q in range(4):
            inside = [p for p in parts if (p[0] - first) // width == q]
            if inside:
                yield from split(inside, first + q * width, depth + 1)

    yield from split(sorted(counts.items()), 0, 0)


def hot_cells(points: DataFrame, x: str, y: str, limit: int) -> DataFrame:
    """(_hl, _hx, _hy, starts, squares) of the cells with more than ``limit``
    of the ``points`` (_pl, _px, _py): for each square of the quadtree its first
    part, box and number of pieces."""
    cell = ["_pl", "_px", "_py"]
    counts = points.groupBy(*cell).count().filter(F.col("count") > limit)
    hot = counts.select(*[F.col(c).alias(f"_h{c}") for c in cell])      # fewer than all points / limit
    same = [points[c] == hot[f"_h{c}"] for c in cell]
    fine = points.join(F.broadcast(hot), same, "left_semi").groupBy(*cell, _fine_cell(x, y).alias("part")).count()
    grouped = fine.groupBy(*cell).agg(F.collect_list("part").alias("parts"), F.collect_list("count").alias("counts"))

    def squares(batches):
        for batch in batches:
            starts, boxes = [], []
            for level, px, py, parts, counts in zip(*[c.to_pylist() for c in batch.columns]):
                rows, side = [], 2.0**level / 2**QUAD_DEPTH
                for first, depth, pieces in quadtree(dict(zip(parts, counts)), limit):
                    column = sum((first >> 2 * b & 1) << b for b in range(QUAD_DEPTH))
                    row = sum((first >> 2 * b + 1 & 1) << b for b in range(QUAD_DEPTH))
                    x0, y0 = (px * 2**QUAD_DEPTH + column) * side, (py * 2**QUAD_DEPTH + row) * side
                    width = side * 2 ** (QUAD_DEPTH - depth)
                    rows.append((first, {"x0": x0, "y0": y0, "x1": x0 + width, "y1": y0 + width, "pieces": pieces}))
                starts.append([first for first, _ in rows])
                boxes.append([box for _, box in rows])
            box = pa.struct([(n, pa.float64()) for n in ("x0", "y0", "x1", "y1")] + [("pieces", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(starts, pa.list_(pa.int64())), pa.array(boxes, pa.list_(box))], ["_hl", "_hx", "_hy", "starts", "squares"])

    return grouped.select("_pl", "_px", "_py", "parts", "counts").mapInArrow(
        squares, "_hl int, _hx long, _hy long, starts array<long>, squares array<struct<x0:double,y0:double,x1:double,y1:double,pieces:int>>")


def _shuffled_spatial_join(points, polygons, levels, x, y, geom_col, how, hot_rows) -> DataFrame:
    """Both sides dealt by cell, square of a hot cell, and piece of a square.

    The limit grows with the points, so there are fewer than MAX_HOT_CELLS hot
    cells and at most QUAD_DEPTH times as many squares that are split: their
    list can be sent everywhere.  The polygons of a hot cell go to the squares
    their boxes touch and to every piece of them.
    """
    pts = stored(points.withColumn("_pid", F.monotonically_increasing_id()), "spatial-points")
    keyed = pts.select("_pid", x, y).filter(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn(
        "_pl", F.explode(F.array(*[F.lit(v).cast("int") for v in levels])))
    px, py = _cell(F.col("_pl"), x, y)
    keyed = keyed.withColumns({"_px": px, "_py": py})
    limit = max(hot_rows, -(-pts.count() * len(levels) // MAX_HOT_CELLS))
    hot = F.broadcast(stored(hot_cells(keyed, x, y, limit), "hot-cells"))

    mine = keyed.join(hot, (keyed["_pl"] == hot["_hl"]) & (keyed["_px"] == hot["_hx"]) & (keyed["_py"] == hot["_hy"]), "left")
    mine = mine.withColumn("_part", F.when(F.col("_hl").isNotNull(), _fine_cell(x, y)))
    mine = mine.withColumn("_square", F.when(F.col("_hl").isNull(), F.lit(-1)).otherwise(
        F.expr(geo.last_not_above("starts", "_part", "greatest(size(starts) - 1, 0)"))))
    mine = mine.withColumn("_piece", F.when(F.col("_hl").isNull(), F.lit(0)).otherwise(
        F.expr("CAST(pmod(xxhash64(_pid), get(squares, _square).pieces) AS INT)")))
    mine = mine.select("_pid", F.col(x).alias("_x"), F.col(y).alias("_y"), "_pl", "_px", "_py", "_square", "_piece")

    cells = grid_cells(polygons, geom_col)
    g = geom_col
    touched = F.expr(
        f"""CASE WHEN _hl IS NULL THEN array(named_struct('square', -1, 'pieces', 1)) ELSE
        filter(transform(squares, (s, i) -> if(s.x0 <= {g}.xmax AND s.x1 >= {g}.xmin AND s.y0 <= {g}.ymax AND s.y1 >= {g}.ymin,
            named_struct('square', i, 'pieces', s.pieces), NULL)), s -> s IS NOT NULL) END""")
    dealt = cells.join(hot, (cells["_level"] == hot["_hl"]) & (cells["_gx"] == hot["_hx"]) & (cells["_gy"] == hot["_hy"]), "left")
    dealt = dealt.withColumn("_touched", F.explode(touched)).drop("_hl", "_hx", "_hy", "starts", "squares")
    dealt = dealt.withColumn("_to_square", F.col("_touched.square")).withColumn(
        "_to_piece", F.explode(F.expr("sequence(0, _touched.pieces - 1)"))).drop("_touched")

    cond = [mine["_pl"] == dealt["_level"], mine["_px"] == dealt["_gx"], mine["_py"] == dealt["_gy"],
            mine["_square"] == dealt["_to_square"], mine["_piece"] == dealt["_to_piece"], geo.st_contains_point(geom_col, "_x", "_y", prepared=True)]
    found = mine.join(dealt, cond, "inner").select(F.col("_pid").alias("_fid"), *[F.col(c) for c in polygons.columns])
    found = found.withColumn(geom_col, geo.plain(geom_col))
    return pts.join(found, pts["_pid"] == found["_fid"], how).drop("_pid", "_fid")


def semi_join_names(df: DataFrame, names: DataFrame, col: str, names_col: str = "nombre",
                    bound: DataFrame | int | None = None) -> DataFrame:
    """Rows whose ``col`` is in the ``names`` list (no text splicing)."""
    keys = names.select(F.col(names_col).alias("_name")).distinct()
    return df.join(bounded_broadcast(keys, bound), df[col] == keys["_name"], "left_semi")


def mark_join(df: DataFrame, names: DataFrame, col: str, yes: str, no: str, out: str, names_col: str = "nombre",
              bound: DataFrame | int | None = None) -> DataFrame:
    """Label rows whose ``col`` is in ``names`` (a left join on distinct names)."""
    keys = names.select(F.col(names_col).alias("_mark")).distinct()
    j = df.join(bounded_broadcast(keys, bound), df[col] == keys["_mark"], "left")
    return j.withColumn(out, F.when(F.col("_mark").isNotNull(), F.lit(yes)).otherwise(F.lit(no))).drop("_mark")
