"""Table contracts: explicit StructTypes for every layer and a NOT NULL check.

Parquet does not enforce nullability, so ``enforce_schema`` casts, orders
columns by the contract and makes every non-nullable column raise on NULL
when the data is materialised (``raise_error`` inside the projection, so
no extra pass over the data is needed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.functions.geo import GEOM


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


S, I, D, B, DT = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.DateType()

# ---- bronze: text as it arrives (leading zeros must survive) ----
BRONZE_TRIPS = _s(
    ("fecha", S, True), ("periodo", S, True), ("origen", S, True),
    ("destino", S, True), ("viajes", S, True), ("viajes_km", S, True),
)
BRONZE_RELACIONES = _s(
    ("municipio_mitma", S, True), ("municipio_ine", S, True),
    ("distrito_mitma", S, True), ("distrito_ine", S, True), ("gau_mitma", S, True),
)
BRONZE_CALENDARIO = _s(("Dia", S, True), ("Dia_semana", S, True), ("laborable", S, True))

# ---- silver ----
SILVER_PROVINCIAS = _s(
    ("cod_provincia", I, False), ("nombre_provincia", S, False),
    ("nombre_alternativo", S, False), ("cod_ccaa", I, False),
    ("nombre_ccaa", S, False), ("geom", GEOM, False),
)
SILVER_POBLACION = _s(("id", I, False), ("poblacion", I, False))
SILVER_RENTA = _s(("id", I, False), ("renta", I, False))
SILVER_CALENDARIO = _s(("fecha", DT, False), ("dia_semana", S, False), ("tipo_dia", B, False))
SILVER_VIAJES = _s(
    ("fecha", DT, False), ("periodo", I, False), ("tipo_zona", S, False),
    ("id_origen", I, False), ("id_destino", I, False),
    ("viajes", D, False), ("viajes_metros", D, False),
)
SILVER_LUGARES = _s(
    ("id", I, False), ("id_mitma", S, False), ("nombre", S, False),
    ("coordenadas", GEOM, False), ("tipo_zona", S, False),
    ("longitude", D, False), ("latitude", D, False), ("cod_provincia", I, True),
)

# ---- gold ----
GOLD_MOBILITY = _s(
    ("id_origen", I, False), ("id_destino", I, False), ("fecha", DT, False),
    ("periodo", S, False), ("total_viajes", D, False), ("avg_viajes_metros", D, False),
)


class ContractError(ValueError):
    pass


def not_null(c: Column, dtype: T.DataType, message: str) -> Column:
    """``c``, or a task failure with ``message`` when it is NULL."""
    return F.coalesce(c, F.raise_error(F.lit(message)).cast(dtype))


def enforce_schema(df: DataFrame, schema: T.StructType, table: str = "table") -> DataFrame:
    """Cast to the contract, keep its column order, raise on NULL in NOT NULL columns.

    Missing columns are a ``ContractError`` at plan time.  The NULL check is
    lazy: it fails the job that first materialises an offending row.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ContractError(f"{table}: missing columns {missing}")
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            c = c.cast(f.dataType)
        if not f.nullable:
            c = not_null(c, f.dataType, f"NOT NULL violated: {table}.{f.name}")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def observed(df: DataFrame, schema: T.StructType, table: str = "table") -> tuple[DataFrame, Observation]:
    """The contract counted instead of enforced, in the pass that writes.

    Columns as ``enforce_schema`` casts and orders them, but values that do
    not cast become NULL and nothing fails; the observation holds, for every
    NOT NULL column, how many rows break it and one of them as it came in (the
    least as JSON).  ``violations`` reads it after the write.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ContractError(f"{table}: missing columns {missing}")
    typed, counts = [], [F.count(F.lit(1)).alias("rows")]
    as_it_came = F.to_json(F.struct(*[F.col(c) for c in df.columns if not isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType))]))
    for f in schema.fields:
        c = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            c = c.try_cast(f.dataType) if not isinstance(f.dataType, T.StructType) else c.cast(f.dataType)
        typed.append(c.alias(f.name))
        if not f.nullable:
            counts.append(F.count_if(c.isNull()).alias(f"n:{f.name}"))
            counts.append(F.min(F.when(c.isNull(), as_it_came)).alias(f"row:{f.name}"))
    watch = Observation(f"contract of {table}")
    return df.observe(watch, *counts).select(*typed), watch


def violations(watch: Observation) -> list[tuple[str, int, str]]:
    """(column, rows that break it, one of them) of an ``observed`` write, worst first."""
    got = watch.get
    found = [(k[2:], n, got[f"row:{k[2:]}"]) for k, n in got.items() if k.startswith("n:") and n]
    return sorted(found, key=lambda v: (-v[1], v[0]))


def contract_error(table: str, found: list[tuple[str, int, str]]) -> ContractError:
    return ContractError(f"{table}: NOT NULL violated: " + "; ".join(f"{column} in {n} rows, such as {row}" for column, n, row in found))
