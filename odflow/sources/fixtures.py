"""Driver tables -> domain tables (FIXTURES.md section 2).

The test parquet files are a TPC-H-like star schema.  These functions
re-shape them into the inputs of the mobility pipeline: bronze text
tables exactly as raw files would arrive, and the typed silver fact.
Everything is a lazy DataFrame over the given tables, so the work grows
with them; ``odflow.oracle`` holds the same derivations in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odflow.functions import geo

# ---- fixed values of the fixture mapping ----
FIRST_DAY = "2023-01-01"
N_DAYS = 14                      # fecha = FIRST_DAY + l_partkey % 14
NA_MOD, NA_REM = 12, 11          # nations with k % 12 = 11 have code 'NA'
FANOUT_NATION, FANOUT_CODE = 3, "90003"   # a second official code for one zone
HALF_SIDE = {"municipio": 0.4, "distrito": 0.3, "gau": 0.2}
LEVEL_FILTER_MOD = {"municipio": 1, "distrito": 2, "gau": 3}   # nation k kept if k % m = 0
LEVEL_SUFFIX = {"municipio": "", "distrito": "-D", "gau": "-G"}
PROVINCE_REGIONS = 4             # regions 0..3 get a strip; region 4 has a NULL code
# query polygons used by the checks
RECT_WKT = "POLYGON((-0.5 -0.5, 2.5 -0.5, 2.5 2.5, -0.5 2.5, -0.5 -0.5))"
CONCAVE_WKT = "POLYGON((-0.5 -0.5, 2.5 -0.5, 2.5 2.5, 1 1, -0.5 2.5, -0.5 -0.5))"
# the same rectangle with heights; a square with a hole, two squares that touch in a point, a square with heights
RECT_Z_WKT = "POLYGON Z((-0.5 -0.5 9, 2.5 -0.5 -9, 2.5 2.5 9, -0.5 2.5 7, -0.5 -0.5 9))"
HOLE_SHAPES = {
    "hole": "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 4 6, 6 6, 6 4, 4 4))",
    "touching": "MULTIPOLYGON(((0 0, 4 0, 4 4, 0 4, 0 0)), ((4 4, 8 4, 8 8, 4 8, 4 4)))",
    "heights": "POLYGON Z((0 0 1, 5 0 20, 5 5 1, 0 5 -7, 0 0 1))",
}


_SCHEMAS: dict[tuple[str, str], object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is inferred once per session (the files are read-only)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _code(k: Column) -> Column:
    return F.lpad(k.cast("string"), 5, "0")


def mitma_code(k: Column) -> Column:
    return F.concat(F.lit("Z"), _code(k))


def _zone_level(linenumber: Column) -> Column:
    m = linenumber % 3
    return F.when(m == 0, "municipios").when(m == 1, "distritos").otherwise("gaus")


def _trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order, customer and supplier (one row per line)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # customers meet the orders, which are fewer than the lines
    placed = od.join(cu, od.o_custkey == cu.c_custkey)
    return li.join(su, li.l_suppkey == su.s_suppkey).join(placed, li.l_orderkey == placed.o_orderkey)


def _fecha(partkey: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), (partkey % N_DAYS).cast("int"))


def viajes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver.viajes: one trip row per line item; integer-valued measures."""
    t = _trip_rows(spark, sf_dir)
    return t.select(
        _fecha(F.col("l_partkey")).alias("fecha"),
        (F.col("l_orderkey") % 24).cast("int").alias("periodo"),
        _zone_level(F.col("l_linenumber")).alias("tipo_zona"),
        F.col("s_nationkey").cast("int").alias("id_origen"),
        F.col("c_nationkey").cast("int").alias("id_destino"),
        F.col("l_quantity").cast("double").alias("viajes"),
        F.round(F.col("l_extendedprice"), 0).cast("double").alias("viajes_metros"),
    )


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip files as text, with the zone level they belong to.

    ``viajes`` gets +0.5 on first lines so the half-to-even rule matters;
    ``periodo`` keeps a leading zero; codes are the 'Z00000' file codes.
    """
    t = _trip_rows(spark, sf_dir)
    half = F.when(F.col("l_linenumber") == 1, F.lit(0.5)).otherwise(F.lit(0.0))
    return t.select(
        _zone_level(F.col("l_linenumber")).alias("tipo_zona"),
        F.date_format(_fecha(F.col("l_partkey")), "yyyy-MM-dd").alias("fecha"),
        F.lpad((F.col("l_orderkey") % 24).cast("string"), 2, "0").alias("periodo"),
        mitma_code(F.col("s_nationkey")).alias("origen"),
        mitma_code(F.col("c_nationkey")).alias("destino"),
        (F.col("l_quantity") + half).cast("decimal(12,1)").cast("string").alias("viajes"),
        (F.floor("l_extendedprice") + 0.25).cast("decimal(14,2)").cast("string").alias("viajes_km"),   # exact as metres
    )


def relaciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code relations: one row per nation, 'NA' for some, one code with two official codes."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    ine = F.when(k % NA_MOD == NA_REM, F.lit("NA")).otherwise(_code(k))
    cols = lambda official: [
        mitma_code(k).alias("municipio_mitma"), official.alias("municipio_ine"),
        mitma_code(k).alias("distrito_mitma"), official.alias("distrito_ine"),
        mitma_code(k).alias("gau_mitma"),
    ]
    base = n.select(*cols(ine))
    extra = n.filter(k == FANOUT_NATION).select(*cols(F.lit(FANOUT_CODE)))
    return base.unionByName(extra).unionByName(extra)


def _nation_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("k"),
        F.concat(_code(F.col("n_nationkey")), F.lit(" "), F.col("n_name")).alias("column0"),
    )


def bronze_poblacion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population file: '<code> <name>', 'Total' with thousands separators.

    Also a year header row (dropped by the cleaning rule), a row with no
    digit in the value and a row with a NULL code.
    """
    cu = table(spark, sf_dir, "customer")
    counts = cu.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    lab = _nation_label(spark, sf_dir)
    rows = lab.join(counts, "k").select("column0", F.format_number(F.col("n") * 1000, 0).alias("Total"))
    reg = table(spark, sf_dir, "region")
    year = reg.filter(F.col("r_regionkey") == 0).select(F.lit(" 2023 ").alias("column0"), F.lit("1,000").alias("Total"))
    nodigit = lab.filter(F.col("k") % 7 == 6).select("column0", F.lit(" . ").alias("Total"))
    nullcode = reg.filter(F.col("r_regionkey") == 1).select(F.lit(None).cast("string").alias("column0"), F.lit("5").alias("Total"))
    return rows.unionByName(year).unionByName(nodigit).unionByName(nullcode)


INCOME_COL = "Renta neta media por persona"


def bronze_renta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income file: whole units of the summed account balance per nation."""
    cu = table(spark, sf_dir, "customer")
    cents = F.round(F.col("c_acctbal") * 100, 0).cast("long")
    sums = cu.groupBy(F.col("c_nationkey").alias("k")).agg(F.sum(cents).alias("cents"))
    lab = _nation_label(spark, sf_dir)
    units = F.floor(F.col("cents") / F.lit(100.0))
    rows = lab.join(sums, "k").select("column0", F.format_number(units, 0).alias(INCOME_COL))
    reg = table(spark, sf_dir, "region")
    year = reg.filter(F.col("r_regionkey") == 0).select(F.lit("2023").alias("column0"), F.lit("7").alias(INCOME_COL))
    return rows.unionByName(year)


def bronze_calendario(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar file: one row per distinct trip day, names padded and upper-case."""
    return calendar_from_trips(viajes(spark, sf_dir))


def calendar_from_trips(trips: DataFrame) -> DataFrame:
    """The calendar file for the days present in a trip table.

    On the written silver table ``fecha`` is a partition column, so this
    reads directory names and file footers only.
    """
    days = trips.select("fecha").distinct()
    dow = F.dayofweek("fecha")
    return days.select(
        F.date_format("fecha", "yyyy-MM-dd").alias("Dia"),
        F.concat(F.lit(" "), F.upper(F.date_format("fecha", "EEEE")), F.lit(" ")).alias("Dia_semana"),
        F.when(dow.isin(1, 7), F.lit("false")).otherwise(F.lit("true")).alias("laborable"),
    )


def bronze_geo(spark: SparkSession, sf_dir: str, place_level: str) -> DataFrame:
    """Zone shapes of one level: squares centred on (k % 5, k div 5)."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    h = f"{HALF_SIDE[place_level]}D"
    cx = "CAST(n_nationkey % 5 AS DOUBLE)"
    cy = "CAST(floor(n_nationkey / 5) AS DOUBLE)"
    return n.filter(k % LEVEL_FILTER_MOD[place_level] == 0).select(
        mitma_code(k).alias("id"),
        F.concat(F.col("n_name"), F.lit(LEVEL_SUFFIX[place_level]), F.lit(" ")).alias("name"),
        geo.rect(f"{cx} - {h}", f"{cy} - {h}", f"{cx} + {h}", f"{cy} + {h}").alias("geom"),
    )


def bronze_provincias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Province shapes: vertical strips per region; the last region has no code."""
    r = table(spark, sf_dir, "region")
    rk = F.col("r_regionkey")
    x = "CAST(r_regionkey AS DOUBLE)"
    return r.select(
        F.when(rk < PROVINCE_REGIONS, rk.cast("string")).alias("Codigo"),
        F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("Texto"),
        F.lower(F.col("r_name")).alias("Texto_Alt"),
        (rk % 2 + 1).cast("string").alias("Cod_CCAA"),
        F.concat(F.lit("CCAA "), (rk % 2 + 1).cast("string")).alias("CCAA"),
        geo.rect(f"{x} - 0.5D", "-0.5D", f"{x} + 0.5D", "4.5D").alias("geom"),
    )


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per customer on a 0.1 grid offset so no point lies on an edge."""
    cu = table(spark, sf_dir, "customer")
    return cu.select(
        F.col("c_custkey").alias("point_id"),
        ((F.col("c_custkey") % 45).cast("double") * 0.1 - 0.43).alias("x"),
        ((F.col("c_custkey") % 53).cast("double") * 0.1 - 0.41).alias("y"),
    )


def customer_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns for separated files: a leading zero in ``id``, separators
    and letters outside ASCII in ``label``, thousands separators in ``value``;
    ``k`` says which file a row goes to."""
    cu = table(spark, sf_dir, "customer")
    return cu.select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("id"),
        F.concat(F.col("c_name"), F.lit(", Güeña; "), F.col("c_mktsegment")).alias("label"),
        F.format_number(F.floor(F.col("c_acctbal")) * 1000, 0).alias("value"),
        F.col("c_custkey").alias("k"),
    )
