"""Ad-hoc questions on the silver layer (C-16 .. C-21)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.functions import geo
from odflow.operators.joins import bounded_broadcast
from odflow.plans.questions import places_in_polygon

# ---- fixed values: parameters of the ad-hoc queries as first written ----
UC4_POLYGON = (
    "POLYGON ((-0.219727 40.763901, -1.560059 39.554883, -0.74707 37.840157, 0.340576 38.728376, "
    "-0.230713 39.470125, 0.648193 40.597271, -0.219727 40.763901))"
)
UC6_DAY = "2023-03-19"
UC6_PLACE = "València"


def uc1_top_income(renta: DataFrame, lugares: DataFrame, n: int = 10) -> DataFrame:
    """C-16: the ``n`` highest incomes with the place name (names break ties)."""
    j = renta.join(lugares.select("id", "nombre"), "id")
    return j.select("nombre", "renta").orderBy(F.col("renta").desc(), F.col("nombre")).limit(n)


def uc2_nonworking_days(calendario: DataFrame) -> DataFrame:
    """C-17: non-working days per month."""
    return (
        calendario.filter(~F.col("tipo_dia"))
        .groupBy(F.month("fecha").alias("month_num"), F.date_format("fecha", "MM - MMMM").alias("month_name"))
        .agg(F.count(F.lit(1)).alias("non_working_days"))
        .orderBy("month_num")
    )


def uc3_top_population(lugares: DataFrame, poblacion: DataFrame, n: int = 10) -> DataFrame:
    """C-18: the ``n`` most populated municipalities."""
    m = lugares.filter(F.col("tipo_zona") == "municipio").select("id", "nombre")
    j = m.join(poblacion, "id")
    return j.select("nombre", "poblacion").orderBy(F.col("poblacion").desc(), F.col("nombre")).limit(n)


def uc4_places_in_polygon(lugares: DataFrame, wkt: str = UC4_POLYGON) -> DataFrame:
    """C-19: places inside the polygon with their centroid coordinates."""
    return places_in_polygon(lugares, wkt).select("id", "nombre", "latitude", "longitude")


def uc4_map_centre(places: DataFrame) -> DataFrame:
    """C-19: mean latitude and longitude (the map centre)."""
    return places.agg(F.avg("latitude").alias("centro_lat"), F.avg("longitude").alias("centro_lon"))


def uc5_province_geojson(provincias: DataFrame) -> DataFrame:
    """C-20: province shapes as GeoJSON text."""
    return provincias.select("nombre_provincia", geo.st_as_geojson("geom").alias("geom_json"))


def uc6_trips_from_place(viajes: DataFrame, lugares: DataFrame, day: str = UC6_DAY, place_name: str = UC6_PLACE,
                         n: int = 10) -> DataFrame:
    """C-21: distinct trips leaving a named place on a day, ``n`` rows.

    The day filter prunes silver partitions; the origin name is resolved
    on the (broadcast) place table before the fact is touched.
    """
    lo = lugares.filter(F.col("nombre") == place_name).select(F.col("id").alias("_lo"), F.col("nombre").alias("origen"))
    ld = lugares.select(F.col("id").alias("_ld"), F.col("nombre").alias("destino"))
    v = viajes.filter(F.col("fecha") == F.lit(day).cast("date"))
    j = v.join(bounded_broadcast(lo, lugares), v["id_origen"] == F.col("_lo")).join(
        bounded_broadcast(ld, lugares), v["id_destino"] == F.col("_ld")
    )
    d = j.select("origen", "destino", "fecha", "viajes", "periodo").distinct()
    return d.orderBy("destino", "periodo", "viajes").limit(n)
