import datetime as dt

import pytest
from pyspark.sql import functions as F

from odflow import schema as S
from odflow.functions import geo
from odflow.params import MobilityParams, resolve_gold_table
from odflow.plans import questions as Q

POLY = "POLYGON((-10 -10, 10 -10, 10 10, -10 10, -10 -10))"


def _places(spark, names):
    rows = [(i + 1, f"Z{i}", n, "municipio", 0.0, 0.0, None) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "id int, id_mitma string, nombre string, tipo_zona string, longitude double, latitude double, cod_provincia int")
    return df.withColumn("coordenadas", geo.rect("-1D", "-1D", "1D", "1D"))


def _calendar(spark, days):
    return spark.createDataFrame([(dt.date(2023, 1, d), "x", d not in (7, 8)) for d in days], S.SILVER_CALENDARIO)


def _gold(spark, rows):
    return spark.createDataFrame([(1, dest, dt.date(2023, 1, d), "8", tv, 1000.0) for dest, d, tv in rows], S.GOLD_MOBILITY)


P = MobilityParams(POLY, "2023-01-01", "2023-01-31")


def test_weekend_zero_sorted_last_and_kept(spark):
    # place 1: workday 100, weekend 0 -> NULL ratio -> percent_rank 1 -> kept
    rows = [(1, 2, 100.0), (1, 7, 0.0)]
    for dest in (2, 3, 4):
        rows += [(dest, 2, 60.0 + dest), (dest, 7, 30.0)]
    out = Q.bq3_ranking(_gold(spark, rows), _places(spark, ["A", "B", "C", "D"]), _calendar(spark, [2, 7]), P)
    got = [(r.nombre, r.ratio, r.percentile) for r in out.collect()]
    assert got == [("A", None, 1.0)]


def test_weekend_missing_dropped_and_single_candidate_empty(spark):
    rows = [(1, 2, 100.0), (2, 2, 80.0), (2, 7, 20.0)]
    out = Q.bq3_ranking(_gold(spark, rows), _places(spark, ["A", "B"]), _calendar(spark, [2, 7]), P)
    assert out.count() == 0


def test_names_with_apostrophe(spark):
    rows = [(1, 2, 100.0), (1, 7, 10.0), (2, 2, 60.0), (2, 7, 30.0)]
    places = _places(spark, ["L'Eliana", "Other"])
    ranking = Q.bq3_ranking(_gold(spark, rows), places, _calendar(spark, [2, 7]), P)
    assert [r.nombre for r in ranking.collect()] == ["L'Eliana"]
    pts = Q.bq3_points(places, ranking, P)
    assert sorted((r.nombre, r.grupo) for r in pts.collect()) == [("L'Eliana", "Top 5%"), ("Other", "Resto")]
    hourly = Q.bq3_hourly(_gold(spark, rows), places, _calendar(spark, [2, 7]), ranking, P)
    assert sorted(tuple(r) for r in hourly.collect()) == [(8, False, 10.0), (8, True, 100.0)]


def test_empty_ranking_gives_no_points(spark):
    places = _places(spark, ["A"])
    empty = spark.createDataFrame([], "nombre string")
    assert Q.bq3_points(places, empty, P).count() == 0


def test_missing_hour_share_zero_raw_mean_skips(spark):
    hourly = spark.createDataFrame(
        [(dt.date(2023, 1, 1), 5, 10.0), (dt.date(2023, 1, 1), 6, 30.0), (dt.date(2023, 1, 2), 6, 20.0)],
        "fecha date, periodo int, total_viajes double")
    v = {r.fecha.day: r for r in Q.day_vectors(hourly).collect()}
    assert v[2].h05 is None and v[2].s05 == 0.0 and v[2].s06 == 1.0
    assert v[1].s05 == 0.25 and v[1].h00 == 0.0        # hour absent everywhere -> 0
    clustered = Q.day_vectors(hourly).withColumn("cluster", F.lit(1))
    prof = Q.cluster_profile(clustered).first()
    assert prof.avg_h05 == 10.0 and prof.avg_h06 == 25.0 and prof.avg_h00 == 0.0


def test_kmeans_needs_k_distinct_vectors(spark):
    hourly = spark.createDataFrame([(dt.date(2023, 1, d), 8, 10.0) for d in (1, 2)], "fecha date, periodo int, total_viajes double")
    with pytest.raises(ValueError, match="k=3"):
        Q.bq1_day_clusters(hourly, k=3, seed=42)


def test_kmeans_separates_profiles(spark):
    rows = []
    for d in range(1, 13):
        peak = 8 if d % 3 == 0 else (18 if d % 3 == 1 else 13)
        rows += [(dt.date(2023, 1, d), h, 100.0 if h == peak else 1.0 + d % 2) for h in range(24)]
    hourly = spark.createDataFrame(rows, "fecha date, periodo int, total_viajes double")
    labels = {r.fecha.day: r.cluster for r in Q.bq1_day_clusters(hourly, 3, 42).collect()}
    groups = {}
    for d, c in labels.items():
        groups.setdefault(c, set()).add(d % 3)
    assert len(groups) == 3 and all(len(v) == 1 for v in groups.values())


def test_unknown_zone_rejected():
    with pytest.raises(ValueError):
        resolve_gold_table("gaus")
    with pytest.raises(ValueError):
        MobilityParams(POLY, "2023-01-01", "2023-01-02", "gaus")


def test_gravity_division_by_zero_is_null(spark):
    base = spark.createDataFrame([("a", "b", 10.0, 0.0, 4.0, 9.0), ("c", "d", 5.0, 5.0, 1.0, 1.0)],
                                 "origen string, destino string, viajes_reales double, potencial double, pop_origen double, pop_destino double")
    out = {r.origen: r for r in Q.gravity_mismatch(base).collect()}
    assert out["a"].mismatch is None and out["a"].pop_weight == 6.0
    # k = (10 + 5) / (0 + 5) = 3, so the second pair is 5 / (5 * 3)
    assert out["c"].mismatch == pytest.approx(1.0 / 3.0)


def test_zone_filter_option(spark):
    # the same id at two levels: faithful mode repeats the trips under both names
    places = _places(spark, ["A"]).unionByName(_places(spark, ["A-D"]).withColumn("tipo_zona", F.lit("distrito")))
    gold = _gold(spark, [(1, 2, 100.0), (1, 7, 10.0)])
    hourly = Q.bq1_hourly_profile(gold.withColumn("id_origen", F.lit(1)), places, P)
    assert hourly.agg(F.sum("total_viajes")).first()[0] == 220.0
    only = MobilityParams(POLY, "2023-01-01", "2023-01-31", zone_filter=True)
    hourly = Q.bq1_hourly_profile(gold.withColumn("id_origen", F.lit(1)), places, only)
    assert hourly.agg(F.sum("total_viajes")).first()[0] == 110.0


def test_bq2_population_rows_multiply_trips(spark):
    # two population rows for the destination id (H-9): every trip row joins
    # both, so the pair's trips double; MAX keeps the larger population
    places = _places(spark, ["A", "B"])
    gold = spark.createDataFrame([(1, 2, dt.date(2023, 1, 2), "8", 10.0, 1000.0),
                                  (1, 2, dt.date(2023, 1, 3), "9", 30.0, 3000.0)], S.GOLD_MOBILITY)
    pop = spark.createDataFrame([(1, 500), (2, 100), (2, 200)], "id int, poblacion int")
    renta = spark.createDataFrame([(2, 7)], "id int, renta int")
    out = Q.bq2_od_base(gold, places, pop, renta, P).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.origen, r.destino, r.viajes_reales) == ("A", "B", 80.0)
    assert (r.pop_origen, r.pop_destino, r.renta_destino) == (500.0, 200.0, 7.0)
    assert r.dist_media == pytest.approx((2 * 10 * 1000.0 + 2 * 30 * 3000.0) / 80.0)


def test_bq3_ratio_is_mean_workday_over_mean_weekend(spark):
    # A: workdays 2, 3 (100, 50) and weekend days 7, 8 (30, 10) -> 75 / 20 = 3.75
    rows = [(1, 2, 100.0), (1, 3, 50.0), (1, 7, 30.0), (1, 8, 10.0)]
    rows += [(2, 2, 60.0), (2, 3, 60.0), (2, 7, 30.0), (2, 8, 30.0)]     # B: 2.0
    out = Q.bq3_ranking(_gold(spark, rows), _places(spark, ["A", "B"]), _calendar(spark, [2, 3, 7, 8]), P).collect()
    assert [(r.nombre, r.workday_v, r.weekend_v, r.ratio, r.percentile) for r in out] == [("A", 75.0, 20.0, 3.75, 1.0)]
