"""Silver layer: typed, cleaned, code-resolved and geo-enriched tables (C-1 .. C-6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow import schema as S
from odflow.functions import geo
from odflow.functions.scalar import (
    has_digit,
    parse_bool,
    parse_date,
    parse_int_strict,
    round_half_even_int,
    strip_thousands,
    try_int,
)
from odflow.operators.joins import bounded_broadcast, resolve_codes, spatial_join_points
from odflow.params import ZONES, ZoneSpec

# ---- fixed values: the header row that the statistics files repeat ----
YEAR_ROW = "2023"


def clean_provinces(bronze: DataFrame) -> DataFrame:
    """C-1: cast codes, trim names, drop rows without a code."""
    out = bronze.filter(F.col("Codigo").isNotNull()).select(
        parse_int_strict("Codigo", "Codigo").alias("cod_provincia"),
        F.trim(F.col("Texto").cast("string")).alias("nombre_provincia"),
        F.trim(F.col("Texto_Alt").cast("string")).alias("nombre_alternativo"),
        parse_int_strict("Cod_CCAA", "Cod_CCAA").alias("cod_ccaa"),
        F.trim(F.col("CCAA").cast("string")).alias("nombre_ccaa"),
        F.col("geom"),
    )
    return S.enforce_schema(out, S.SILVER_PROVINCIAS, "silver.provincias")


def _clean_stat(bronze: DataFrame, code_col: str, value_col: str, out_col: str, schema, table: str) -> DataFrame:
    """Shared rule of C-2 / C-3.

    Code = first five characters of the trimmed label; the year header row
    is dropped (NULL labels too: the comparison is NULL); the row is kept
    only if the code parses and the value has a digit; thousands
    separators are removed.  Both parses are NULL-safe in the filter and
    strict in the projection, so evaluation order cannot matter.
    """
    label = F.trim(F.col(f"`{code_col}`"))
    raw = bronze.filter(label != YEAR_ROW).select(
        F.substring(label, 1, 5).alias("_code"),
        F.trim(F.col(f"`{value_col}`")).alias("_value"),
    )
    kept = raw.filter(try_int("_code").isNotNull() & has_digit("_value"))
    out = kept.select(
        parse_int_strict("_code", "code").alias("id"),
        parse_int_strict(strip_thousands("_value"), out_col).alias(out_col),
    )
    return S.enforce_schema(out, schema, table)


def clean_population(bronze: DataFrame, code_col: str = "column0", value_col: str = "Total") -> DataFrame:
    """C-2 silver.poblacion."""
    return _clean_stat(bronze, code_col, value_col, "poblacion", S.SILVER_POBLACION, "silver.poblacion")


def clean_income(bronze: DataFrame, code_col: str = "column0", value_col: str = "Renta neta media por persona") -> DataFrame:
    """C-3 silver.renta."""
    return _clean_stat(bronze, code_col, value_col, "renta", S.SILVER_RENTA, "silver.renta")


def clean_calendar(bronze: DataFrame) -> DataFrame:
    """C-4 silver.calendario: date, lower-case weekday, working-day flag."""
    kept = bronze.filter(
        F.col("Dia").isNotNull() & F.col("Dia_semana").isNotNull() & F.col("laborable").isNotNull()
    )
    flag = parse_bool("laborable")
    out = kept.select(
        parse_date("Dia", strict=True).alias("fecha"),
        F.lower(F.trim("Dia_semana")).alias("dia_semana"),
        S.not_null(flag, S.B, "cannot cast laborable to BOOLEAN").alias("tipo_dia"),
    )
    return S.enforce_schema(out, S.SILVER_CALENDARIO, "silver.calendario")


def resolve_trips(bronze: DataFrame, relaciones: DataFrame, spec: ZoneSpec) -> DataFrame:
    """C-5 for one zone level: file codes -> official ids, typed measures.

    Both code lookups are broadcast joins against the distinct code pairs
    (a bounded dimension); trips whose code has no parseable official id
    are dropped, a code with two ids yields two rows.  Trips are rounded
    half to even, kilometres become metres.  A km value that does not
    parse fails the load (NOT NULL contract).
    """
    facts = bronze.filter(F.col("viajes_km").isNotNull())
    facts = resolve_codes(facts, relaciones, "origen", spec.mitma_col, spec.ine_col, "id_origen")
    facts = resolve_codes(facts, relaciones, "destino", spec.mitma_col, spec.ine_col, "id_destino")
    out = facts.select(
        parse_date("fecha", strict=True).alias("fecha"),
        parse_int_strict("periodo", "periodo").alias("periodo"),
        F.lit(spec.level).alias("tipo_zona"),
        F.col("id_origen"),
        F.col("id_destino"),
        round_half_even_int(
            S.not_null(F.trim("viajes").try_cast("double"), S.D, "cannot cast viajes to DOUBLE")
        ).cast("double").alias("viajes"),
        (F.trim("viajes_km").try_cast("double") * 1000).alias("viajes_metros"),
    )
    return S.enforce_schema(out, S.SILVER_VIAJES, "silver.viajes")


def code_dimension(relaciones: DataFrame) -> DataFrame:
    """(zone level, file code, official id) for every level, one pass.

    Each level reads its own pair of columns (gaus resolves to the district
    id); pairs are deduplicated as text, ids that do not parse are dropped.
    """
    pairs = [
        relaciones.select(F.lit(z.level).alias("_level"), F.col(z.mitma_col).alias("_code"), F.col(z.ine_col).alias("_ine"))
        for z in ZONES.values()
    ]
    long = reduce(DataFrame.unionByName, pairs).distinct()
    return long.select("_level", "_code", try_int("_ine").alias("_id")).filter(F.col("_id").isNotNull())


def silver_trips(bronze_by_level: dict[str, DataFrame], relaciones: DataFrame) -> DataFrame:
    """C-5 for every level present, in one pass over the trip files.

    The levels are concatenated with their level as a column and joined
    once per side to the long code dimension on (level, code): one scan of
    each trip file, two broadcast hash joins, no shuffle.
    """
    tagged = [df.select(F.lit(level).alias("tipo_zona"), *df.columns) for level, df in bronze_by_level.items()]
    return resolve_all_levels(reduce(DataFrame.unionByName, tagged), relaciones)


def resolve_all_levels(bronze: DataFrame, relaciones: DataFrame) -> DataFrame:
    """C-5 on trips that carry their zone level in ``tipo_zona``."""
    dim = bounded_broadcast(code_dimension(relaciones))
    o = dim.select(F.col("_level").alias("_lo"), F.col("_code").alias("_co"), F.col("_id").alias("id_origen"))
    d = dim.select(F.col("_level").alias("_ld"), F.col("_code").alias("_cd"), F.col("_id").alias("id_destino"))
    facts = bronze.filter(F.col("viajes_km").isNotNull())
    j = facts.join(o, (facts["tipo_zona"] == o["_lo"]) & (facts["origen"] == o["_co"])).join(
        d, (facts["tipo_zona"] == d["_ld"]) & (facts["destino"] == d["_cd"])
    )
    out = j.select(
        parse_date("fecha", strict=True).alias("fecha"),
        parse_int_strict("periodo", "periodo").alias("periodo"),
        F.col("tipo_zona"),
        F.col("id_origen"),
        F.col("id_destino"),
        round_half_even_int(
            S.not_null(F.trim("viajes").try_cast("double"), S.D, "cannot cast viajes to DOUBLE")
        ).cast("double").alias("viajes"),
        (F.trim("viajes_km").try_cast("double") * 1000).alias("viajes_metros"),
    )
    return S.enforce_schema(out, S.SILVER_VIAJES, "silver.viajes")


def place_branch(geo_df: DataFrame, relaciones: DataFrame, spec: ZoneSpec) -> DataFrame:
    """One level of the place catalogue: shapes joined to their official ids, distinct."""
    pairs = relaciones.select(F.col(spec.mitma_col).alias("_m"), F.col(spec.ine_col).alias("_i")).distinct()
    j = geo_df.join(bounded_broadcast(pairs, relaciones), geo_df["id"] == pairs["_m"], "inner")
    return j.select(
        try_int("_i").alias("id"),
        F.col("id").alias("id_mitma"),
        F.trim("name").alias("nombre"),
        F.col("geom").alias("coordenadas"),
        F.lit(spec.place_level).alias("tipo_zona"),
    ).distinct()


def place_catalogue(geo_by_level: dict[str, DataFrame], relaciones: DataFrame, provincias: DataFrame) -> DataFrame:
    """C-6 silver.lugares: all levels, centroid, province of the centroid.

    Branches are deduplicated separately and concatenated (no dedupe across
    levels).  The province is found with a grid spatial join of centroids
    against province shapes, left outer: no province gives NULL.
    """
    parts = [place_branch(df, relaciones, ZONES[level]) for level, df in geo_by_level.items()]
    places = reduce(DataFrame.unionByName, parts).filter(F.col("id").isNotNull() & F.col("nombre").isNotNull())
    c = geo.st_centroid("coordenadas")
    places = places.withColumn("_c", c).select(
        "*", F.col("_c")["x"].alias("longitude"), F.col("_c")["y"].alias("latitude")
    ).drop("_c")
    prov = provincias.select("cod_provincia", F.col("geom").alias("_pgeom"))
    out = spatial_join_points(places, prov, x="longitude", y="latitude", geom_col="_pgeom", how="left").drop("_pgeom")
    return S.enforce_schema(out, S.SILVER_LUGARES, "silver.lugares")
