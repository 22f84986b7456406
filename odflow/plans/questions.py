"""Business questions on the gold layer (C-8 .. C-15).

Every function takes DataFrames and a ``MobilityParams`` and returns a lazy
DataFrame.  Building a plan runs only small jobs, once per session and input:
the polygon literal is parsed, the ids of its places are listed, and counts
of the dimension tables (places, population, income, calendar; rows, and rows
of an id) prove that they and what is joined of them can be broadcast.  The gold fact is streamed once; where a result is used twice
(the BQ2 base, the BQ1 hourly totals) callers store it first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.functions import geo
from odflow.functions.scalar import safe_div
from odflow.operators.joins import bounded_broadcast, dim_rows, fan_out, key_ranges, mark_join, semi_join_names, within
from odflow.operators.profiles import HOUR_COLS, kmeans_labels, normalise_rows, pivot_hours, share_cols
from odflow.operators.ranking import percent_rank
from odflow.params import ZONES, MobilityParams

# ---- fixed values of the questions ----
MIN_WORKDAY_VOLUME = 50        # BQ3 keeps places with more average workday trips
TOP_PERCENTILE = 0.95          # BQ3 keeps the top 5 % by ratio
TOP_LABEL, REST_LABEL = "Top 5%", "Resto"
MAX_WINDOW_ROWS = 1_000_000    # places that one task may sort
BQ2_MAP_ROWS, BQ2_CHART_ROWS, BQ2_LIST_ROWS = 50, 10, 15

def places_in_polygon(lugares: DataFrame, wkt: str, geom_col: str = "coordenadas") -> DataFrame:
    """Places whose whole shape lies in the polygon (``ST_Contains(poly, shape)``).

    The box test is written as plain comparisons on the stored bounding box
    so it reaches the Parquet reader as pushed filters; the exact test runs
    only on the survivors.  The polygon literal is parsed once.
    """
    xmin, ymin, xmax, ymax = geo.geom_literal_box(lugares.sparkSession, wkt)
    poly = geo.geom_literal_sql(lugares.sparkSession, wkt)
    return lugares.filter(geo.bbox_within(geom_col, xmin, ymin, xmax, ymax)).filter(
        geo.st_contains(poly, geom_col, prepared=True)
    )


def catalogue(lugares: DataFrame, p: MobilityParams) -> DataFrame:
    """The places a question joins to: all levels, or the question's level with ``zone_filter``."""
    if not p.zone_filter:
        return lugares
    return lugares.filter(F.col("tipo_zona") == ZONES[p.tipo_zona].place_level)


def from_polygon(gold: DataFrame, lugares: DataFrame, p: MobilityParams) -> DataFrame:
    """Gold rows of the period whose origin may lie in the polygon: the ids of
    its places as literal ranges.  The join with the places decides; the ranges
    let the scan skip row groups, which hold few origins each."""
    inside = places_in_polygon(catalogue(lugares, p), p.polygon)
    ranges = key_ranges(inside, "id", lugares, p.polygon, p.tipo_zona, p.zone_filter)
    return _in_period(gold, p).filter(within("id_origen", ranges))


def per_id(stat: DataFrame, value: str, p: MobilityParams) -> DataFrame:
    """Population or income rows: as loaded, or one (max) value per id with ``zone_filter``."""
    if not p.zone_filter:
        return stat
    return stat.groupBy("id").agg(F.max(value).alias(value))


def _in_period(df: DataFrame, p: MobilityParams) -> DataFrame:
    return df.filter(F.col("fecha").between(F.lit(p.start_date).cast("date"), F.lit(p.end_date).cast("date")))


# ------------------------------------------------------------------ BQ1

def bq1_hourly_totals(gold: DataFrame, lugares: DataFrame, p: MobilityParams) -> DataFrame:
    """C-8 without the final order: trips per day and hour leaving places inside the polygon.

    The pivot and the clustering regroup these rows, so they take this
    unordered frame (a global sort would cost a sampling job and a range
    shuffle for nothing).
    """
    v = from_polygon(gold, lugares, p)
    lugares = catalogue(lugares, p)
    origins = places_in_polygon(lugares, p.polygon).select(F.col("id").alias("_oid"))
    j = v.join(bounded_broadcast(origins, lugares), v["id_origen"] == F.col("_oid"))
    return j.groupBy("fecha", F.col("periodo").cast("int").alias("periodo")).agg(
        F.sum("total_viajes").alias("total_viajes")
    )


def bq1_hourly_profile(gold: DataFrame, lugares: DataFrame, p: MobilityParams) -> DataFrame:
    """C-8: trips per day and hour leaving places inside the polygon, ordered by day and hour."""
    return bq1_hourly_totals(gold, lugares, p).orderBy("fecha", "periodo")


def day_vectors(hourly: DataFrame) -> DataFrame:
    """One row per day: raw hourly totals h00..h23 and their shares s00..s23."""
    wide = pivot_hours(hourly, "fecha", "periodo", "total_viajes")
    return normalise_rows(wide, HOUR_COLS, "s")


def bq1_day_clusters(hourly: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """C-9: k-means on the daily share vectors, the best of several starts;
    cluster labels 1..k in order of their first days."""
    return kmeans_labels(day_vectors(hourly), share_cols("s"), k, seed, order_col="fecha")


def nearest_own_mean(clustered: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Per day whether its cluster's mean vector is the nearest of all means
    (at most k rows), and the number of clusters: what a finished k-means
    must satisfy, however its labels are numbered."""
    cols = features or share_cols("s")
    means = clustered.groupBy("cluster").agg(F.array(*[F.avg(c) for c in cols]).alias("m"))
    means = means.agg(F.collect_list(F.struct("cluster", "m")).alias("means")).scalar()
    own = F.array(*[F.col(c).cast("double") for c in cols])

    def distance(m):
        return F.aggregate(F.zip_with(own, m["m"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)

    out = clustered.withColumn("_means", means).withColumn("_d", F.transform("_means", lambda m: F.struct(distance(m).alias("d"), m["cluster"].alias("c"))))
    mine = F.element_at(F.filter("_d", lambda x: x["c"] == F.col("cluster")), 1)["d"]
    return out.select("fecha", (mine <= F.array_min(F.transform("_d", lambda x: x["d"])) + F.lit(1e-12)).alias("nearest"),
                      F.size("_means").alias("n_clusters"))


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Mean raw total per hour and mean share per hour, by cluster (NULLs skipped)."""
    aggs = [F.avg(c).alias(f"avg_{c}") for c in HOUR_COLS] + [F.avg(c).alias(f"avg_{c}") for c in share_cols("s")]
    return clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_days"), *aggs)


# ------------------------------------------------------------------ BQ2

def bq2_fact(gold: DataFrame, lugares: DataFrame, poblacion: DataFrame, renta: DataFrame, p: MobilityParams) -> DataFrame:
    """The star join of C-10: gold rows of the period with their origin place
    (in the polygon, with population) and destination place (with population
    and income).

    The small tables are joined among themselves first (same inner joins,
    same fan-out), so each gold row is probed against two broadcast sides
    instead of five.
    """
    v = from_polygon(gold, lugares, p)
    lugares = catalogue(lugares, p)
    mo = places_in_polygon(lugares, p.polygon).select(
        F.col("id").alias("_mo"), F.col("nombre").alias("origen"),
        F.col("latitude").alias("o_lat"), F.col("longitude").alias("o_lon"),
    )
    md = lugares.select(
        F.col("id").alias("_md"), F.col("nombre").alias("destino"),
        F.col("latitude").alias("d_lat"), F.col("longitude").alias("d_lon"),
    )
    poblacion, renta = per_id(poblacion, "poblacion", p), per_id(renta, "renta", p)
    po = poblacion.select(F.col("id").alias("_po"), F.col("poblacion").alias("_pop_o"))
    pd_ = poblacion.select(F.col("id").alias("_pd"), F.col("poblacion").alias("_pop_d"))
    r = renta.select(F.col("id").alias("_r"), F.col("renta").alias("_renta"))
    origin_dim = mo.join(po, F.col("_mo") == F.col("_po")).drop("_po")
    dest_dim = md.join(pd_, F.col("_md") == F.col("_pd")).join(r, F.col("_md") == F.col("_r")).drop("_pd", "_r")
    # places times the rows that an id has in the tables joined to them
    n_origins = dim_rows(lugares) * fan_out(poblacion, "id")
    n_dests = n_origins * fan_out(renta, "id")
    return (
        v.join(bounded_broadcast(origin_dim, known_rows=n_origins), v["id_origen"] == F.col("_mo"))
        .join(bounded_broadcast(dest_dim, known_rows=n_dests), v["id_destino"] == F.col("_md"))
    )


def bq2_od_base(gold: DataFrame, lugares: DataFrame, poblacion: DataFrame, renta: DataFrame,
                p: MobilityParams) -> DataFrame:
    """C-10: origin-destination pairs with trips, weighted distance, population, income, potential."""
    j = bq2_fact(gold, lugares, poblacion, renta, p)
    tv, am = F.col("total_viajes"), F.col("avg_viajes_metros")
    base = j.groupBy("origen", "destino", "o_lat", "o_lon", "d_lat", "d_lon").agg(
        F.sum(tv).alias("viajes_reales"),
        safe_div(F.sum(tv * am), F.sum(tv)).alias("dist_media"),
        F.max("_pop_o").cast("double").alias("pop_origen"),
        F.max("_pop_d").cast("double").alias("pop_destino"),
        F.max("_renta").cast("double").alias("renta_destino"),
    )
    return base.withColumn(
        "potencial", safe_div(F.col("pop_origen") * F.col("renta_destino"), F.pow(F.col("dist_media"), 2))
    )


def gravity_mismatch(base: DataFrame) -> DataFrame:
    """C-11: k = sum(real) / sum(potential) over the whole result, then per pair
    mismatch = real / (potential * k), weighted by sqrt(pop_o * pop_d).

    ``base`` is read twice, so callers pass a stored one.  The global sums
    are one aggregate read as a scalar subquery: Spark runs it once and uses
    the value as a constant (no join).  Division by zero gives NULL, not
    infinity.
    """
    k = base.agg(safe_div(F.sum("viajes_reales"), F.sum("potencial"))).scalar()
    return base.select(
        *[F.col(c) for c in base.columns],
        safe_div(F.col("viajes_reales"), F.col("potencial") * k).alias("mismatch"),
        F.sqrt(F.col("pop_origen") * F.col("pop_destino")).alias("pop_weight"),
    ).withColumn("weighted_mismatch", F.col("mismatch") * F.col("pop_weight"))


def bq2_ranking(scored: DataFrame, n: int, ascending: bool) -> DataFrame:
    """Top or bottom ``n`` pairs by weighted mismatch; NULL last, names break ties."""
    w = F.col("weighted_mismatch")
    order = w.asc_nulls_last() if ascending else w.desc_nulls_last()
    return scored.orderBy(order, F.col("origen").asc(), F.col("destino").asc()).limit(n)


# ------------------------------------------------------------------ BQ3

def bq3_daily(gold: DataFrame, lugares: DataFrame, p: MobilityParams) -> DataFrame:
    """Trips per day into each place name inside the polygon."""
    lugares = catalogue(lugares, p)
    dest = places_in_polygon(lugares, p.polygon).select(F.col("id").alias("_lid"), "nombre")
    v = _in_period(gold, p)
    return (
        v.join(bounded_broadcast(dest, lugares), v["id_destino"] == F.col("_lid"))
        .groupBy("nombre", "fecha")
        .agg(F.sum("total_viajes").alias("trips_per_day"))
    )


def bq3_place_stats(daily: DataFrame, calendario: DataFrame) -> DataFrame:
    """Mean day total of workdays and of weekend days, one row per place name.

    (The mean per day type is one value per name and type, so averaging it
    again per name is the same number; one aggregation does both.)
    """
    cal = calendario.select("fecha", "tipo_dia")
    return daily.join(bounded_broadcast(cal, calendario), "fecha").groupBy("nombre").agg(
        F.avg(F.when(F.col("tipo_dia"), F.col("trips_per_day"))).alias("workday_v"),
        F.avg(F.when(~F.col("tipo_dia"), F.col("trips_per_day"))).alias("weekend_v"),
    )


def bq3_scored(stats: DataFrame, min_volume: float | None = MIN_WORKDAY_VOLUME, n_places: int | None = None) -> DataFrame:
    """Workday/weekend ratio and its percent rank among the places over the
    minimum volume.  ``n_places``: a bound of the rows, one per place, from the
    catalogue; up to MAX_WINDOW_ROWS one sort ranks them, beyond and without
    a bound they are ranked by ranges."""
    kept = stats.filter(F.col("weekend_v").isNotNull())
    if min_volume is not None:
        kept = kept.filter(F.col("workday_v") > min_volume)
    kept = kept.withColumn("ratio", safe_div(F.col("workday_v"), F.col("weekend_v")))
    if n_places is None or n_places > MAX_WINDOW_ROWS:
        return percent_rank(kept, "ratio", "percentile")
    return kept.withColumn("percentile", F.percent_rank().over(Window.orderBy(F.col("ratio").asc_nulls_last())))


def bq3_ranking(gold: DataFrame, lugares: DataFrame, calendario: DataFrame, p: MobilityParams) -> DataFrame:
    """C-12: places whose workday/weekend volume ratio is in the top 5 %."""
    scored = bq3_scored(bq3_place_stats(bq3_daily(gold, lugares, p), calendario), n_places=dim_rows(lugares))
    return scored.filter(F.col("percentile") >= TOP_PERCENTILE).orderBy(F.col("ratio").desc_nulls_last())


def bq3_hourly(gold: DataFrame, lugares: DataFrame, calendario: DataFrame, ranking: DataFrame,
               p: MobilityParams) -> DataFrame:
    """C-13: hourly totals by day type into the ranked places."""
    lugares = catalogue(lugares, p)
    ranked = semi_join_names(lugares, ranking, "nombre", bound=lugares).select(F.col("id").alias("_lid"))
    cal = calendario.select("fecha", "tipo_dia")
    v = _in_period(gold, p)
    j = v.join(bounded_broadcast(ranked, lugares), v["id_destino"] == F.col("_lid")).join(
        bounded_broadcast(cal, calendario), "fecha")
    return (
        j.groupBy(F.col("periodo").cast("int").alias("periodo"), "tipo_dia")
        .agg(F.sum("total_viajes").alias("total_viajes"))
        .orderBy("periodo", "tipo_dia")
    )


def bq3_flows(gold: DataFrame, lugares: DataFrame, ranking: DataFrame, p: MobilityParams) -> DataFrame:
    """C-14: flows into the ranked places, mean coordinates per (origin, destination) name."""
    lugares = catalogue(lugares, p)
    mo = lugares.select(
        F.col("id").alias("_mo"), F.col("nombre").alias("origen"),
        F.col("latitude").alias("_olat"), F.col("longitude").alias("_olon"),
    )
    md = semi_join_names(lugares, ranking, "nombre", bound=lugares).select(
        F.col("id").alias("_md"), F.col("nombre").alias("destino"),
        F.col("latitude").alias("_dlat"), F.col("longitude").alias("_dlon"),
    )
    v = _in_period(gold, p)
    # the selective side (ranked destinations) first: most gold rows stop at one probe
    j = v.join(bounded_broadcast(md, lugares), v["id_destino"] == F.col("_md")).join(
        bounded_broadcast(mo, lugares), v["id_origen"] == F.col("_mo")
    )
    return j.groupBy("origen", "destino").agg(
        F.avg("_olat").alias("o_lat"), F.avg("_olon").alias("o_lon"),
        F.avg("_dlat").alias("d_lat"), F.avg("_dlon").alias("d_lon"),
        F.sum("total_viajes").alias("viajeros"),
    )


def bq3_points(lugares: DataFrame, ranking: DataFrame, p: MobilityParams) -> DataFrame:
    """C-15: places inside the polygon labelled 'Top 5%' or 'Resto'.

    Like the report, nothing is produced when the ranking is empty; the
    check is a scalar subquery (a count run once), not a driver round trip.
    """
    lugares = catalogue(lugares, p)
    pts = places_in_polygon(lugares, p.polygon).select("nombre", "latitude", "longitude")
    labelled = mark_join(pts, ranking, "nombre", TOP_LABEL, REST_LABEL, "grupo", bound=lugares)
    return labelled.filter(ranking.agg(F.count(F.lit(1))).scalar() > 0)
