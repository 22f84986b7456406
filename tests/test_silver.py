import datetime as dt

import pytest
from pyspark.sql import functions as F

from odflow import schema as S
from odflow.params import ZONES
from odflow.plans import silver as SV


def test_population_cleaning_rules(spark):
    rows = [("44001 Ababuj", "1,234"), (" 2023 ", "5"), ("44002", "."), (None, "5"), ("x", "9"), ("44003 B", " 77 ")]
    df = spark.createDataFrame(rows, "column0 string, Total string")
    got = sorted(tuple(r) for r in SV.clean_population(df).collect())
    assert got == [(44001, 1234), (44003, 77)]


def test_income_bad_value_fails_load(spark):
    df = spark.createDataFrame([("44001", "12a,3")], "column0 string, `Renta neta media por persona` string")
    with pytest.raises(Exception, match="cannot cast"):
        SV.clean_income(df).collect()


def test_calendar_cleaning(spark):
    df = spark.createDataFrame([("2023-01-02", " MONDAY ", "true"), ("20230101", "Sunday", "false"), (None, "x", "true")],
                               "Dia string, Dia_semana string, laborable string")
    got = sorted(tuple(r) for r in SV.clean_calendar(df).collect())
    assert got == [(dt.date(2023, 1, 1), "sunday", False), (dt.date(2023, 1, 2), "monday", True)]


def _rel(spark, rows):
    return spark.createDataFrame(rows, S.BRONZE_RELACIONES)


def _trips(spark, rows):
    return spark.createDataFrame(rows, S.BRONZE_TRIPS)


def test_resolution_fanout_dedupe_and_na(spark):
    rel = _rel(spark, [
        ("Z1", "00001", "Z1", "00001", "Z1"),
        ("Z1", "00001", "Z1", "00001", "Z1"),      # duplicate relation row: one match
        ("Z2", "00002", "Z2", "00002", "Z2"),
        ("Z2", "90002", "Z2", "90002", "Z2"),      # second official code: two rows
        ("Z3", "NA", "Z3", "NA", "Z3"),            # unmapped
    ])
    trips = _trips(spark, [
        ("2023-01-01", "00", "Z1", "Z2", "12.5", "12.25"),
        ("2023-01-01", "01", "Z1", "Z3", "13.5", "1"),
        ("20230102", "02", "Z1", "Z1", "3", "0.5"),
    ])
    out = SV.resolve_trips(trips, rel, ZONES["municipios"])
    got = sorted(tuple(r) for r in out.collect())
    assert got == [
        (dt.date(2023, 1, 1), 0, "municipios", 1, 2, 12.0, 12250.0),
        (dt.date(2023, 1, 1), 0, "municipios", 1, 90002, 12.0, 12250.0),
        (dt.date(2023, 1, 2), 2, "municipios", 1, 1, 3.0, 500.0),
    ]
    # the one-pass version over all levels agrees
    both = SV.silver_trips({"municipios": trips, "gaus": trips}, rel)
    assert sorted(tuple(r) for r in both.filter(F.col("tipo_zona") == "municipios").collect()) == got
    assert both.filter(F.col("tipo_zona") == "gaus").count() == 3


def test_bad_km_fails_load(spark):
    rel = _rel(spark, [("Z1", "00001", "Z1", "00001", "Z1")])
    trips = _trips(spark, [("2023-01-01", "00", "Z1", "Z1", "1", "x")])
    with pytest.raises(Exception, match="NOT NULL"):
        SV.resolve_trips(trips, rel, ZONES["municipios"]).collect()


def test_enforce_schema_contract(spark):
    df = spark.createDataFrame([(1, None)], "id int, poblacion int")
    with pytest.raises(Exception, match="NOT NULL violated: t.poblacion"):
        S.enforce_schema(df, S.SILVER_POBLACION, "t").collect()
    with pytest.raises(S.ContractError):
        S.enforce_schema(df.drop("poblacion"), S.SILVER_POBLACION, "t")


def test_place_catalogue_with_provinces(spark):
    from odflow.functions import geo
    rel = _rel(spark, [("Z1", "00001", "Z1", "00001", "Z1"), ("Z9", "NA", "Z9", "NA", "Z9")])
    geo_df = spark.createDataFrame([("Z1", " Uno ", "POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))"),
                                    ("Z9", "Nueve", "POLYGON((0 0, 1 0, 1 1, 0 0))")], "id string, name string, w string") \
        .select("id", "name", geo.geom_from_wkt("w").alias("geom"))
    far = spark.createDataFrame([("Z1", "Lejos", "POLYGON((50 50, 52 50, 52 52, 50 52, 50 50))")], "id string, name string, w string") \
        .select("id", "name", geo.geom_from_wkt("w").alias("geom"))
    prov = spark.createDataFrame([("7", "P", "p", "1", "C", "POLYGON((-1 -1, 5 -1, 5 5, -1 5, -1 -1))")],
                                 "Codigo string, Texto string, Texto_Alt string, Cod_CCAA string, CCAA string, w string") \
        .select("Codigo", "Texto", "Texto_Alt", "Cod_CCAA", "CCAA", geo.geom_from_wkt("w").alias("geom"))
    prov = SV.clean_provinces(prov)
    out = SV.place_catalogue({"municipios": geo_df, "distritos": far}, rel, prov)
    got = sorted((r.id, r.nombre, r.tipo_zona, r.longitude, r.latitude, r.cod_provincia) for r in out.collect())
    assert got == [(1, "Lejos", "distrito", 51.0, 51.0, None), (1, "Uno", "municipio", 1.0, 1.0, 7)]
