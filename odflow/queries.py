"""Registry of checked queries: one per operator / composite of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables (through the fixture mapping) or over the lake Spark builds
from them.  ``odflow.oracle`` has the matching DuckDB SQL; column names
are the same on both sides.  Floating results that are not computed
identically by both engines (ratios, weighted means, coordinates) are
rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import glob
import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflow import schema as S
from odflow.functions import geo
from odflow.functions.scalar import (
    fixed_decimals,
    has_digit,
    latin1_text,
    parse_date,
    parse_int_strict,
    round_half_even_int,
    try_int,
)
from odflow.lake import Lake
from odflow.operators.joins import bounded_broadcast, mark_join, semi_join_names, spatial_join_points
from odflow.operators.profiles import HOUR_COLS, assign_nearest, first_rows_as_centres, inertia, share_cols
from odflow.params import ZONES, MobilityParams
from odflow.plans import gold as G
from odflow.plans import pipeline, reports
from odflow.plans import questions as Q
from odflow.plans import silver as SV
from odflow.plans import usecases as U
from odflow.session import scratch_path, spread, stored
from odflow.sources import files, storage
from odflow.sources import fixtures as fx
from odflow.sources.fixture_lake import fixture_lake, source_key, trip_folder
from odflow.streaming.ingest import LEVEL_FILES, start_trip_ingest

# ---- fixed values: parameters of the checked queries ----
PERIOD = ("2023-01-01", "2023-01-14")
PARAMS = MobilityParams(fx.RECT_WKT, PERIOD[0], PERIOD[1], "municipios")
PARAMS_DISTRITOS = MobilityParams(fx.RECT_WKT, PERIOD[0], PERIOD[1], "distritos", zone_filter=True)
PARAMS_WIDE = MobilityParams("POLYGON((-1 -1, 5 -1, 5 6, -1 6, -1 -1))", PERIOD[0], PERIOD[1], "municipios")   # all places
STREAM_FILES = 40                               # files of each level in a micro-batch
UC6_DAY, UC6_PLACE = "2023-01-03", "NATION_5"
FILTER_DAY, FILTER_LEVEL = "2023-01-03", "gaus"
BETWEEN = ("2023-01-02", "2023-01-05")
RELOAD_LAST_DAY = "2023-01-07"                  # zone reload keeps days up to this one
RELOAD_DAYS = ["2023-01-02", "2023-01-03", "2023-01-20"]
RELOAD_EMPTIED = "2023-01-03"                   # requested day whose rows are gone
N_CENTRES = 3                                   # centres of the deterministic assignment

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}
_FILES_LOCK = threading.Lock()


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        return fn
    return deco


def registry() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


def r6(c):
    return F.round(c, 6)


def _lake(spark, sf) -> Lake:
    return fixture_lake(spark, sf)


def _silver(spark, sf, name) -> DataFrame:
    return _lake(spark, sf).read("silver", name)


def _gold(spark, sf, level="municipios") -> DataFrame:
    return _lake(spark, sf).read("gold", ZONES[level].gold_table)


def _bbox_cols(g: str):
    return [F.col(g)["xmin"].alias("xmin"), F.col(g)["ymin"].alias("ymin"),
            F.col(g)["xmax"].alias("xmax"), F.col(g)["ymax"].alias("ymax")]


def _scratch(spark, sf, *parts) -> str:
    return scratch_path(spark, "files", source_key(spark, sf), *parts)


def _fresh(spark, *parts) -> str:
    return scratch_path(spark, "runs", *parts, uuid.uuid4().hex[:12])


# =================================================================== sources

@query("empty_from_schema")
def q_empty_from_schema(spark, sf):
    cols = [f.name for f in S.BRONZE_TRIPS.fields]
    return fx.bronze_trips(spark, sf).select(*cols).limit(0)


@query("csv_scan_trips")
def q_csv_scan_trips(spark, sf):
    """Every trip file of every level (name filter on 'Viajes_')."""
    return files.read_trip_csv(spark, trip_folder(spark, sf), "Viajes_")


def _daily_folder(spark, sf) -> str:
    """One gzip file a day of the municipal trips, named by its day."""
    root = _scratch(spark, sf, "raw", "daily")
    with _FILES_LOCK:
        if not storage.exists(spark, f"{root}/_ready"):
            tmp = f"{root}_tmp_{uuid.uuid4().hex[:8]}"
            df = fx.bronze_trips(spark, sf).filter(F.col("tipo_zona") == "municipios").drop("tipo_zona")
            (df.withColumn("day", F.regexp_replace("fecha", "-", "")).repartition("day").write.partitionBy("day")
             .option("header", True).option("sep", "|").option("compression", "gzip").csv(tmp))
            for path, _, _ in storage.listing(spark, tmp):
                if path.endswith(".csv.gz"):
                    day = path.split("/")[-2].split("=")[1]
                    storage.rename(spark, path, f"{root}/{day}_{LEVEL_FILES['municipios']}.csv.gz")
            storage.touch(spark, f"{root}/_ready")
    return root


@query("csv_daily_files")
def q_csv_daily_files(spark, sf):
    """The date-stamped files of a range of days, no listing; each holds its own day only."""
    paths = files.daily_paths(_daily_folder(spark, sf), LEVEL_FILES["municipios"], *BETWEEN)
    return files.read_trip_csv(spark, paths, day_in_name=True)


def _written(spark, sf, name: str, make) -> str:
    """Folder of a raw file that ``make(folder)`` writes with Spark, once."""
    root = _scratch(spark, sf, "raw", name)
    with _FILES_LOCK:
        if not storage.exists(spark, f"{root}/_SUCCESS"):
            make(root)
    return root


def _relations_file(spark, sf) -> str:
    return _written(spark, sf, "relaciones", lambda root: fx.relaciones(spark, sf).write.mode("overwrite")
                    .option("header", True).option("sep", "|").csv(root))


def _stat_file(spark, sf, name: str) -> str:
    """A statistics CSV whose first header cell is blank, with a column nobody asked for."""
    df = {"poblacion": fx.bronze_poblacion, "renta": fx.bronze_renta}[name](spark, sf)
    df = df.withColumn("other", F.lit("x")).withColumnRenamed("column0", " ")
    return _written(spark, sf, name, lambda root: df.write.mode("overwrite").option("header", True)
                    .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root))


@query("csv_scan_stats")
def q_csv_scan_stats(spark, sf):
    """Both statistics files, columns by name, every value as text."""
    pob = files.read_stat_csv(spark, _stat_file(spark, sf, "poblacion"), ["column0", "Total"])
    ren = files.read_stat_csv(spark, _stat_file(spark, sf, "renta"), ["column0", fx.INCOME_COL])
    return pob.select(F.lit("poblacion").alias("source"), "column0", F.col("Total").alias("value")).unionByName(
        ren.select(F.lit("renta").alias("source"), "column0", F.col(f"`{fx.INCOME_COL}`").alias("value")))


def _dialect_files(spark, sf) -> list[str]:
    """Customers in files of three dialects, columns in three orders: commas and
    double quotes, semicolons and single quotes, bars without quotes in Latin-1."""
    cu = fx.customer_file(spark, sf)
    names = cu.columns[:3]
    kinds = {"comma": (",", '"', "UTF-8", names), "semicolon": (";", "'", "UTF-8", names[::-1]),
             "bar": ("|", "", "ISO-8859-1", [names[1], names[0], names[2]])}
    out = []
    for i, (kind, (sep, quote, encoding, order)) in enumerate(kinds.items()):
        part = cu.filter(F.col("k") % 3 == i).select(*order)
        out.append(_written(spark, sf, f"customers-{kind}", lambda root: part.write.mode("overwrite").option("header", True)
                            .option("sep", sep).option("quote", quote).option("escape", quote).option("encoding", encoding)
                            .option("ignoreTrailingWhiteSpace", False).csv(root)))
    return out


@query("csv_detect_dialects")
def q_csv_detect_dialects(spark, sf):
    """Every customer, read back from files whose dialects are not told."""
    paths = [p for folder in _dialect_files(spark, sf) for p in files.list_files(spark, folder)]
    return files.read_detected(spark, paths, ["id", "label", "value"])


@query("schema_from_sample")
def q_schema_from_sample(spark, sf):
    """Column names of the table made from one sample trip file, in its order."""
    sample = files.list_files(spark, trip_folder(spark, sf), "Viajes_municipios")[0]
    names = files.empty_like(spark, sample).schema.names
    days = fx.bronze_trips(spark, sf).select("fecha").distinct()
    return days.select("fecha", F.lit("|".join(names)).alias("columns"))


@query("csv_all_varchar")
def q_csv_all_varchar(spark, sf):
    return files.read_all_varchar(spark, _relations_file(spark, sf), S.BRONZE_RELACIONES)


def _geo_file(spark, sf, level: str) -> str:
    src = fx.bronze_geo(spark, sf, ZONES[level].place_level)
    return _written(spark, sf, f"geo-{level}", lambda root: files.feature_json(src, ["id", "name"]).write.mode("overwrite").text(root))


@query("geojson_scan")
def q_geojson_scan(spark, sf):
    parts = [files.read_geojson(spark, _geo_file(spark, sf, lv), ["id", "name"], sequence=True)
             .withColumn("tipo_zona", F.lit(ZONES[lv].place_level)) for lv in ZONES]
    g = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return g.select("tipo_zona", "id", "name", F.col("geom")["kind"].alias("kind"),
                    F.size(F.col("geom")["edges"]).alias("n_edges"), *_bbox_cols("geom"))


def _collection_file(spark, sf) -> str:
    """One FeatureCollection document with a square for every customer."""
    features = files.feature_json(_customer_squares(spark, sf), ["point_id"], "g").select(F.col("value").alias("feature"))

    def write(root):
        one = features.repartitionByRange(1, "feature").sortWithinPartitions("feature")      # a document is one file
        lines = one.select(F.concat(F.when(F.monotonically_increasing_id() > 0, ",").otherwise(
            '{"type": "FeatureCollection", "name": "squares", "features": ['), "feature").alias("value"))
        end = spark.range(1, numPartitions=1).select(F.lit("]}").alias("value"))
        lines.unionAll(end).coalesce(1).write.mode("overwrite").text(root)

    return _written(spark, sf, "squares", write)


@query("geojson_collection_scan")
def q_geojson_collection_scan(spark, sf):
    """Features of one large document, cut between features."""
    g = files.read_geojson(spark, _collection_file(spark, sf), ["point_id"])
    return g.select("point_id", F.col("geom")["kind"].alias("kind"), F.size(F.col("geom")["edges"]).alias("n_edges"), *[
        r6(F.col("geom")[c]).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query("day_spine")
def q_day_spine(spark, sf):
    v = _silver(spark, sf, "viajes")
    bounds = v.agg(F.min("fecha").alias("d0"), F.max("fecha").alias("d1"))
    spine = bounds.select(F.explode(F.sequence("d0", "d1")).alias("d"))
    counts = v.groupBy("fecha").agg(F.count(F.lit(1)).alias("n_trips"))
    j = spine.join(counts, spine["d"] == counts["fecha"], "left")
    return j.select(F.date_format("d", "yyyy-MM-dd").alias("day"), F.coalesce("n_trips", F.lit(0)).alias("n_trips"))


# =================================================================== sinks

@query("ctas_roundtrip")
def q_ctas_roundtrip(spark, sf):
    lake = Lake(spark, _fresh(spark, "ctas"))
    lake.overwrite(SV.clean_income(fx.bronze_renta(spark, sf)), "silver", "renta")
    return lake.read("silver", "renta")


@query("not_null_contract")
def q_not_null_contract(spark, sf):
    return S.enforce_schema(fx.viajes(spark, sf), S.SILVER_VIAJES, "silver.viajes")


@query("contract_report")
def q_contract_report(spark, sf):
    """What a checked load says of customers that break three rules, one row a rule."""
    cu = fx.table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")).alias("id_origen"),                     # missing
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey").cast("string")).otherwise("n/a").alias("id_destino"),    # no number
        F.lit("2023-01-01").alias("fecha"), F.lit("0").alias("periodo"), F.lit(1.0).alias("total_viajes"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("avg_viajes_metros"))                 # negative ones left out
    table = Lake(spark, _fresh(spark, "contract"))
    typed, watch = S.observed(cu, S.GOLD_MOBILITY, "gold.mobility")
    table.overwrite(typed, "gold", "mobility")
    found = [(c, n) for c, n, _ in S.violations(watch)]       # one row for each broken rule
    return spark.createDataFrame(found, "column string, n_rows long").withColumn(
        "rows_read", table.read("gold", "mobility").agg(F.count("*")).scalar())


@query("append_union")
def q_append_union(spark, sf):
    lake = Lake(spark, _fresh(spark, "append"))
    v = _silver(spark, sf, "viajes")
    for level in ZONES:
        lake.append(S.enforce_schema(v.filter(F.col("tipo_zona") == level), S.SILVER_VIAJES), "silver", "viajes")
    return lake.read("silver", "viajes")


@query("replace_partition_zone")
def q_replace_partition_zone(spark, sf):
    lake = Lake(spark, _fresh(spark, "zone"))
    v = _silver(spark, sf, "viajes")
    pipeline.write_viajes(lake, v)
    fewer = v.filter(F.col("fecha") <= F.lit(RELOAD_LAST_DAY).cast("date"))
    for _ in range(2):                                    # a reload twice equals once
        pipeline.write_viajes(lake, fewer, levels=["gaus"])
    return lake.read("silver", "viajes").select(*[f.name for f in S.SILVER_VIAJES.fields])


@query("replace_partition_day")
def q_replace_partition_day(spark, sf):
    lake = Lake(spark, _fresh(spark, "day"))
    v = _silver(spark, sf, "viajes")
    G.write_gold(lake, v, "municipios")
    without = v.filter(F.col("fecha") != F.lit(RELOAD_EMPTIED).cast("date"))
    G.write_gold(lake, without, "municipios", days=RELOAD_DAYS)
    return lake.read("gold", ZONES["municipios"].gold_table).select(*[f.name for f in S.GOLD_MOBILITY.fields])


# =================================================================== cleaning (C-1 .. C-4)

@query("clean_provinces")
def q_clean_provinces(spark, sf):
    p = SV.clean_provinces(fx.bronze_provincias(spark, sf))
    return p.select("cod_provincia", "nombre_provincia", "nombre_alternativo", "cod_ccaa", "nombre_ccaa", *_bbox_cols("geom"))


@query("clean_population")
def q_clean_population(spark, sf):
    return SV.clean_population(fx.bronze_poblacion(spark, sf))


@query("clean_income")
def q_clean_income(spark, sf):
    return SV.clean_income(fx.bronze_renta(spark, sf))


@query("clean_calendar")
def q_clean_calendar(spark, sf):
    return SV.clean_calendar(fx.bronze_calendario(spark, sf))


# =================================================================== filters / projections

@query("filter_not_null")
def q_filter_not_null(spark, sf):
    return _lugares_union(spark, sf).filter(F.col("id").isNotNull() & F.col("nombre").isNotNull()) \
        .select("id", "id_mitma", "nombre", "tipo_zona")


@query("filter_neq_trim")
def q_filter_neq_trim(spark, sf):
    return fx.bronze_poblacion(spark, sf).filter(F.trim("column0") != SV.YEAR_ROW)


@query("filter_eq")
def q_filter_eq(spark, sf):
    v = _silver(spark, sf, "viajes")
    return v.filter((F.col("fecha") == F.lit(FILTER_DAY).cast("date")) & (F.col("tipo_zona") == FILTER_LEVEL)) \
        .select(*[f.name for f in S.SILVER_VIAJES.fields])


@query("filter_between_dates")
def q_filter_between_dates(spark, sf):
    g = _gold(spark, sf)
    return g.filter(F.col("fecha").between(F.lit(BETWEEN[0]).cast("date"), F.lit(BETWEEN[1]).cast("date")))


@query("filter_parses_int")
def q_filter_parses_int(spark, sf):
    b = fx.bronze_poblacion(spark, sf)
    return b.filter(try_int(F.substring(F.trim("column0"), 1, 5)).isNotNull())


@query("filter_regex_digit")
def q_filter_regex_digit(spark, sf):
    b = fx.bronze_poblacion(spark, sf)
    return b.filter(has_digit(F.trim("Total")))


@query("filter_in_polygon")
def q_filter_in_polygon(spark, sf):
    return Q.places_in_polygon(_silver(spark, sf, "lugares"), fx.RECT_WKT).select("id", "nombre", "tipo_zona")


@query("metres_from_km")
def q_metres_from_km(spark, sf):
    b = fx.bronze_trips(spark, sf)
    m = F.trim("viajes_km").try_cast("double") * 1000
    return b.groupBy("tipo_zona", "origen", "destino").agg(F.round(F.sum(m), 2).alias("viajes_metros"))


# =================================================================== joins

def _lugares_union(spark, sf) -> DataFrame:
    rel = fx.relaciones(spark, sf)
    parts = [SV.place_branch(fx.bronze_geo(spark, sf, ZONES[lv].place_level), rel, ZONES[lv]) for lv in ZONES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("lugares_union")
def q_lugares_union(spark, sf):
    return _lugares_union(spark, sf).select("id", "id_mitma", "nombre", "tipo_zona", *_bbox_cols("coordenadas"))


@query("join_resolve_codes")
def q_join_resolve_codes(spark, sf):
    """Per-level code resolution (one broadcast lookup per side and level), summed per OD pair.

    Each level reads its own daily trip files, as a per-level load does.
    """
    rel = fx.relaciones(spark, sf)
    parts = [SV.resolve_trips(files.read_trip_csv(spark, trip_folder(spark, sf), LEVEL_FILES[lv]), rel, ZONES[lv]) for lv in ZONES]
    t = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return t.groupBy("tipo_zona", "id_origen", "id_destino").agg(
        F.count(F.lit(1)).alias("n_trips"), F.sum("viajes").alias("viajes")
    )


@query("silver_trips")
def q_silver_trips(spark, sf):
    """C-5 from the daily trip files of all three levels, one pass."""
    by_level = {lv: files.read_trip_csv(spark, trip_folder(spark, sf), LEVEL_FILES[lv]) for lv in ZONES}
    return SV.silver_trips(by_level, fx.relaciones(spark, sf))


def _bq2_inputs(spark, sf):
    return (_gold(spark, sf), _silver(spark, sf, "lugares"), _silver(spark, sf, "poblacion"), _silver(spark, sf, "renta"), PARAMS)


@query("join_star_5way")
def q_join_star_5way(spark, sf):
    j = Q.bq2_fact(*_bq2_inputs(spark, sf))
    return j.groupBy("origen", "destino").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_viajes").alias("total_viajes"))


@query("spatial_left_join")
def q_spatial_left_join(spark, sf):
    pts = fx.customer_points(spark, sf)
    prov = SV.clean_provinces(fx.bronze_provincias(spark, sf)).select("cod_provincia", F.col("geom").alias("_pgeom"))
    j = spatial_join_points(pts, prov, x="x", y="y", geom_col="_pgeom", how="left")
    return j.select("point_id", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"), "cod_provincia")


@query("point_in_polygon")
def q_point_in_polygon(spark, sf):
    pts = spread(fx.customer_points(spark, sf))
    poly = geo.geom_literal_sql(spark, fx.CONCAVE_WKT)
    return pts.filter(geo.st_contains_point(poly, "x", "y", prepared=True)).select("point_id")


@query("mark_join_group")
def q_mark_join_group(spark, sf):
    """Every place of every level, marked by whether its name is ranked."""
    lug = _silver(spark, sf, "lugares")
    m = mark_join(lug.select("id", "nombre", "tipo_zona"), _bq3_ranking(spark, sf), "nombre", "ranked", "other", "grupo", bound=lug)
    return m.select("id", "nombre", "tipo_zona", "grupo")


@query("join_calendar")
def q_join_calendar(spark, sf):
    g = _gold(spark, sf)
    cal = _silver(spark, sf, "calendario").select("fecha", "tipo_dia")
    daily = g.groupBy("fecha").agg(F.sum("total_viajes").alias("total_viajes"))
    return daily.join(bounded_broadcast(cal, _silver(spark, sf, "calendario")), "fecha").select("fecha", "tipo_dia", "total_viajes")


@query("semi_join_names")
def q_semi_join_names(spark, sf):
    g = _gold(spark, sf)
    lug = _silver(spark, sf, "lugares")
    ids = semi_join_names(lug, _bq3_ranking(spark, sf), "nombre", bound=lug).select(F.col("id").alias("_id")).distinct()
    return g.join(bounded_broadcast(ids, lug), g["id_destino"] == F.col("_id"), "left_semi")


# =================================================================== aggregates

@query("agg_sum")
def q_agg_sum(spark, sf):
    return _silver(spark, sf, "viajes").groupBy("tipo_zona", "fecha").agg(F.sum("viajes").alias("total_viajes"))


@query("agg_avg")
def q_agg_avg(spark, sf):
    return _silver(spark, sf, "viajes").groupBy("tipo_zona", "periodo").agg(F.avg("viajes_metros").alias("avg_viajes_metros"))


@query("agg_max_pick")
def q_agg_max_pick(spark, sf):
    g = _gold(spark, sf)
    pob = _silver(spark, sf, "poblacion").select(F.col("id").alias("_id"), "poblacion")
    j = g.join(bounded_broadcast(pob, _silver(spark, sf, "poblacion")), g["id_destino"] == F.col("_id"))
    return j.groupBy("id_destino").agg(
        F.max("poblacion").cast("double").alias("pop_destino"), F.sum("total_viajes").alias("total_viajes")
    )


def _bq3_daily(spark, sf) -> DataFrame:
    return Q.bq3_daily(_gold(spark, sf), _silver(spark, sf, "lugares"), PARAMS)


def _bq3_stats(spark, sf) -> DataFrame:
    return Q.bq3_place_stats(_bq3_daily(spark, sf), _silver(spark, sf, "calendario"))


@query("agg_two_level")
def q_agg_two_level(spark, sf):
    """Sum per day, then mean per day type, as rows."""
    long = _bq3_stats(spark, sf).selectExpr("nombre", "stack(2, true, workday_v, false, weekend_v) AS (tipo_dia, avg_daily_vol)")
    return long.filter("avg_daily_vol IS NOT NULL").select("nombre", "tipo_dia", r6(F.col("avg_daily_vol")).alias("avg_daily_vol"))


@query("agg_conditional")
def q_agg_conditional(spark, sf):
    return _bq3_stats(spark, sf).select("nombre", r6(F.col("workday_v")).alias("workday_v"), r6(F.col("weekend_v")).alias("weekend_v"))


@query("agg_weighted_mean")
def q_agg_weighted_mean(spark, sf):
    g = _gold(spark, sf)
    tv, am = F.col("total_viajes"), F.col("avg_viajes_metros")
    return g.groupBy("id_origen", "id_destino").agg(
        r6(F.try_divide(F.sum(tv * am), F.nullif(F.sum(tv), F.lit(0.0)))).alias("dist_media")
    )


@query("distinct_rows")
def q_distinct_rows(spark, sf):
    return _silver(spark, sf, "viajes").select("tipo_zona", "id_origen", "id_destino", "fecha").distinct()


# =================================================================== windows / ranking

@query("percent_rank")
def q_percent_rank(spark, sf):
    ranked = Q.bq3_scored(_bq3_stats(spark, sf), min_volume=None)
    return ranked.select("nombre", r6(F.col("ratio")).alias("ratio"), r6(F.col("percentile")).alias("percentile"))


def _bq3_ranking(spark, sf, p=PARAMS) -> DataFrame:
    return Q.bq3_ranking(_gold(spark, sf, p.tipo_zona), _silver(spark, sf, "lugares"), _silver(spark, sf, "calendario"), p)


def _ranking_out(df: DataFrame) -> DataFrame:
    return df.select("nombre", *[r6(F.col(c)).alias(c) for c in ("workday_v", "weekend_v", "ratio", "percentile")])


@query("bq3_ranking")
def q_bq3_ranking(spark, sf):
    return _ranking_out(_bq3_ranking(spark, sf))


@query("bq3_ranking_wide")
def q_bq3_ranking_wide(spark, sf):
    """The ranking over a polygon around all places: several rows in the top 5 %."""
    return _ranking_out(_bq3_ranking(spark, sf, PARAMS_WIDE))


@query("top_percentile")
def q_top_percentile(spark, sf):
    return _ranking_out(_bq3_ranking(spark, sf, PARAMS_DISTRITOS))


# =================================================================== BQ3 rest

@query("bq3_hourly")
def q_bq3_hourly(spark, sf):
    return Q.bq3_hourly(_gold(spark, sf), _silver(spark, sf, "lugares"), _silver(spark, sf, "calendario"),
                        stored(_bq3_ranking(spark, sf), "bq3-ranking"), PARAMS)


@query("bq3_flows")
def q_bq3_flows(spark, sf):
    f = Q.bq3_flows(_gold(spark, sf), _silver(spark, sf, "lugares"), stored(_bq3_ranking(spark, sf), "bq3-ranking"), PARAMS)
    return f.select("origen", "destino", *[r6(F.col(c)).alias(c) for c in ("o_lat", "o_lon", "d_lat", "d_lon")], "viajeros")


def _bq3_points(spark, sf):
    p = Q.bq3_points(_silver(spark, sf, "lugares"), stored(_bq3_ranking(spark, sf), "bq3-ranking"), PARAMS)
    return p.select("nombre", r6(F.col("latitude")).alias("latitude"), r6(F.col("longitude")).alias("longitude"), "grupo")


@query("bq3_points")
def q_bq3_points(spark, sf):
    return _bq3_points(spark, sf)


@query("report_lines_bq3")
def q_report_lines_bq3(spark, sf):
    r = _bq3_ranking(spark, sf)
    return r.select(F.format_string("- %s: Ratio %s", latin1_text(F.col("nombre")), fixed_decimals("ratio", 2)).alias("line"))


# =================================================================== BQ2

def _bq2_base(spark, sf) -> DataFrame:
    return Q.bq2_od_base(*_bq2_inputs(spark, sf))


_BQ2_FLOATS = ("o_lat", "o_lon", "d_lat", "d_lon", "dist_media", "potencial")


@query("bq2_od_base")
def q_bq2_od_base(spark, sf):
    b = _bq2_base(spark, sf)
    return b.select("origen", "destino", "viajes_reales", "pop_origen", "pop_destino", "renta_destino",
                    *[r6(F.col(c)).alias(c) for c in _BQ2_FLOATS])


@query("gravity_potential")
def q_gravity_potential(spark, sf):
    b = _bq2_base(spark, sf)
    return b.select("origen", "destino", r6(F.col("potencial")).alias("potencial"))


def _scored(spark, sf) -> DataFrame:
    return Q.gravity_mismatch(stored(_bq2_base(spark, sf), "bq2-base"))


def _scored_out(df: DataFrame) -> DataFrame:
    return df.select("origen", "destino", "viajes_reales",
                     *[r6(F.col(c)).alias(c) for c in ("potencial", "mismatch", "pop_weight", "weighted_mismatch")])


@query("gravity_mismatch")
def q_gravity_mismatch(spark, sf):
    return _scored_out(_scored(spark, sf))


@query("bq2_result_table")
def q_bq2_result_table(spark, sf):
    """The scored pairs as the report run writes them."""
    lake = Lake(spark, _lake(spark, sf).root)
    return _scored_out(reports.run_bq2(lake, PARAMS)["scored_pairs"])


@query("bq2_bottom50")
def q_bq2_bottom50(spark, sf):
    return _scored_out(Q.bq2_ranking(_scored(spark, sf), Q.BQ2_MAP_ROWS, ascending=True))


@query("bq2_top10")
def q_bq2_top10(spark, sf):
    return _scored_out(Q.bq2_ranking(_scored(spark, sf), Q.BQ2_CHART_ROWS, ascending=False))


@query("bq2_top15")
def q_bq2_top15(spark, sf):
    return _scored_out(Q.bq2_ranking(_scored(spark, sf), Q.BQ2_LIST_ROWS, ascending=False))


@query("report_lines_bq2")
def q_report_lines_bq2(spark, sf):
    top = Q.bq2_ranking(_scored(spark, sf), Q.BQ2_LIST_ROWS, ascending=False)
    return top.select(
        F.format_string("%s -> %s | Weighted mismatch: %s", latin1_text(F.col("origen")), latin1_text(F.col("destino")),
                        fixed_decimals("weighted_mismatch", 4)).alias("line")
    )


# =================================================================== BQ1

def _hourly(spark, sf) -> DataFrame:
    return Q.bq1_hourly_profile(_gold(spark, sf), _silver(spark, sf, "lugares"), PARAMS)


def _hourly_totals(spark, sf) -> DataFrame:
    """The same rows unordered and stored, for the pivot and the clustering."""
    return stored(Q.bq1_hourly_totals(_gold(spark, sf), _silver(spark, sf, "lugares"), PARAMS), "bq1-hourly")


@query("bq1_hourly_profile")
def q_bq1_hourly_profile(spark, sf):
    return _hourly(spark, sf)


@query("pivot_hours")
def q_pivot_hours(spark, sf):
    return Q.day_vectors(_hourly_totals(spark, sf)).select("fecha", *HOUR_COLS)


@query("row_normalise")
def q_row_normalise(spark, sf):
    return Q.day_vectors(_hourly_totals(spark, sf)).select("fecha", *[r6(F.col(c)).alias(c) for c in share_cols("s")])


def _assigned(spark, sf) -> DataFrame:
    """Each day to the nearest of the first three days' share vectors (one Lloyd assignment step)."""
    vectors = Q.day_vectors(_hourly_totals(spark, sf))
    centres = first_rows_as_centres(vectors, "fecha", share_cols("s"), N_CENTRES)
    return assign_nearest(vectors, share_cols("s"), centres)


@query("kmeans_assign_fixed")
def q_kmeans_assign_fixed(spark, sf):
    return _assigned(spark, sf).select("fecha", "cluster")


@query("cluster_profile")
def q_cluster_profile(spark, sf):
    p = Q.cluster_profile(_assigned(spark, sf))
    return p.select("cluster", "n_days", *[r6(F.col(c)).alias(c) for c in p.columns if c.startswith("avg_")])


@query("bq1_day_clusters")
def q_bq1_day_clusters(spark, sf):
    """Labels and inertia of the day clusters, and that every day is nearest to its own cluster's mean."""
    days = stored(Q.bq1_day_clusters(_hourly_totals(spark, sf), PARAMS.k, PARAMS.seed), "bq1-clusters")
    near = Q.nearest_own_mean(days)
    return near.join(days.select("fecha", "cluster"), "fecha").withColumn("inertia", F.round(inertia(days, share_cols("s")), 9))


# =================================================================== scalar functions

@query("cast_int")
def q_cast_int(spark, sf):
    b = fx.bronze_poblacion(spark, sf)
    code = F.substring(F.trim("column0"), 1, 5)
    kept = b.filter((F.trim("column0") != SV.YEAR_ROW) & try_int(code).isNotNull())
    return kept.select("column0", parse_int_strict(code, "code").alias("id"))


@query("cast_int_round")
def q_cast_int_round(spark, sf):
    b = fx.bronze_trips(spark, sf)
    return b.groupBy("tipo_zona", "fecha").agg(
        F.sum(round_half_even_int(F.col("viajes").try_cast("double"))).alias("viajes")
    )


@query("try_cast_na")
def q_try_cast_na(spark, sf):
    r = fx.relaciones(spark, sf).select("municipio_mitma", "municipio_ine").distinct()
    return r.select("municipio_mitma", "municipio_ine", try_int("municipio_ine").alias("id"))


@query("cast_date")
def q_cast_date(spark, sf):
    b = fx.bronze_trips(spark, sf).select("fecha").distinct()
    return b.select(F.col("fecha").alias("fecha_text"), parse_date("fecha", strict=True).alias("fecha"))


@query("latin1_text")
def q_latin1_text(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select("doc_id", F.length("text").alias("n_in"), F.length(latin1_text(F.col("text"))).alias("n_out"))


def _customer_squares(spark, sf) -> DataFrame:
    pts = spread(fx.customer_points(spark, sf))
    a = lambda c, d: F.format_string("%.2f", F.col(c) + F.lit(d))
    wkt = F.format_string(
        "POLYGON((%s %s, %s %s, %s %s, %s %s, %s %s))",
        a("x", -0.1), a("y", -0.1), a("x", 0.1), a("y", -0.1), a("x", 0.1), a("y", 0.1),
        a("x", -0.1), a("y", 0.1), a("x", -0.1), a("y", -0.1),
    )
    return pts.select("point_id", wkt.alias("wkt")).select("point_id", geo.geom_from_wkt("wkt").alias("g"))


@query("wkt_parse")
def q_wkt_parse(spark, sf):
    g = _customer_squares(spark, sf)
    return g.select("point_id", r6(geo.st_area("g")).alias("area"), *_bbox_cols("g"))


@query("polygon_in_polygon")
def q_polygon_in_polygon(spark, sf):
    """Customer squares lying in the concave polygon (ST_Contains of two polygons)."""
    poly = geo.geom_literal_sql(spark, fx.CONCAVE_WKT)
    g = _customer_squares(spark, sf)
    xmin, ymin, xmax, ymax = geo.geom_literal_box(spark, fx.CONCAVE_WKT)
    return g.filter(geo.bbox_within("g", xmin, ymin, xmax, ymax)).filter(geo.st_contains(poly, "g", prepared=True)).select("point_id")


@query("polygon_with_holes")
def q_polygon_with_holes(spark, sf):
    """Small squares, one per customer, against a square with a hole (also
    filled exactly), two squares that touch in a point, and a Z polygon."""
    corner = "CAST({} AS DOUBLE)".format
    x, y = corner("c_custkey % 9"), corner("c_custkey DIV 9 % 9")
    w = corner("1 + c_custkey DIV 81 % 3")
    inner = geo.rect_sql(x, y, f"{x} + {w}", f"{y} + {w}")
    c = spread(fx.table(spark, sf, "customer").select("c_custkey")).select("c_custkey", F.expr(inner).alias("g"))
    tests = [F.struct(F.lit(name).alias("shape"), geo.st_contains(geo.geom_literal_sql(spark, wkt), "g", prepared=True).alias("inside"))
             for name, wkt in fx.HOLE_SHAPES.items()]
    return c.select(F.col("c_custkey").alias("point_id"), F.explode(F.array(*tests)).alias("t")).select("t.shape", "point_id", "t.inside")


@query("filter_in_z_polygon")
def q_filter_in_z_polygon(spark, sf):
    """Places in a polygon given with heights: its box comes from the parsed shape."""
    return Q.places_in_polygon(_silver(spark, sf, "lugares"), fx.RECT_Z_WKT).select("id", "nombre", "tipo_zona")


@query("centroid_xy")
def q_centroid_xy(spark, sf):
    g = _customer_squares(spark, sf).select("point_id", geo.st_centroid("g").alias("c"))
    return g.select("point_id", r6(F.col("c")["x"]).alias("x"), r6(F.col("c")["y"]).alias("y"))


# =================================================================== composites

@query("silver_places")
def q_silver_places(spark, sf):
    lug = _silver(spark, sf, "lugares")
    return lug.select("id", "id_mitma", "nombre", "tipo_zona", r6(F.col("longitude")).alias("longitude"),
                      r6(F.col("latitude")).alias("latitude"), "cod_provincia")


def _rollup(level):
    def fn(spark, sf):
        return G.gold_rollup(_silver(spark, sf, "viajes"), level)
    return fn


for _lv in ZONES:
    query(f"gold_rollup_{_lv}")(_rollup(_lv))


@query("uc1_top_income")
def q_uc1(spark, sf):
    return U.uc1_top_income(_silver(spark, sf, "renta"), _silver(spark, sf, "lugares"))


@query("uc2_nonworking_days")
def q_uc2(spark, sf):
    return U.uc2_nonworking_days(_silver(spark, sf, "calendario"))


@query("uc2_all_months")
def q_uc2_all_months(spark, sf):
    """Non-working days by month over a calendar of several years, cleaned from raw text."""
    days = fx.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("fecha"))
    return U.uc2_nonworking_days(SV.clean_calendar(fx.calendar_from_trips(days)))


@query("uc3_top_population")
def q_uc3(spark, sf):
    return U.uc3_top_population(_silver(spark, sf, "lugares"), _silver(spark, sf, "poblacion"))


@query("uc4_places_in_polygon")
def q_uc4(spark, sf):
    p = U.uc4_places_in_polygon(_silver(spark, sf, "lugares"), fx.RECT_WKT)
    return p.select("id", "nombre", r6(F.col("latitude")).alias("latitude"), r6(F.col("longitude")).alias("longitude"))


@query("uc4_map_centre")
def q_uc4_centre(spark, sf):
    c = U.uc4_map_centre(U.uc4_places_in_polygon(_silver(spark, sf, "lugares"), fx.RECT_WKT))
    return c.select(r6(F.col("centro_lat")).alias("centro_lat"), r6(F.col("centro_lon")).alias("centro_lon"))


@query("uc5_province_geojson")
def q_uc5(spark, sf):
    return U.uc5_province_geojson(_silver(spark, sf, "provincias"))


@query("uc6_trips_from_place")
def q_uc6(spark, sf):
    return U.uc6_trips_from_place(_silver(spark, sf, "viajes"), _silver(spark, sf, "lugares"), UC6_DAY, UC6_PLACE)


# =================================================================== streaming

@query("stream_ingest_trips")
def q_stream_ingest_trips(spark, sf):
    """Daily trip files ingested by the streaming path (available-now trigger) into a fresh lake."""
    lake = Lake(spark, _fresh(spark, "stream"))
    q = start_trip_ingest(spark, trip_folder(spark, sf), lake, fx.relaciones(spark, sf), _fresh(spark, "stream_ckpt"),
                          max_files_per_trigger=STREAM_FILES)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"ingest stream failed: {q.exception()}")
    return lake.read("silver", "viajes").select(*[f.name for f in S.SILVER_VIAJES.fields])
