"""Readers for the raw inputs: trip CSV files, statistics CSVs, relations, GeoJSON.

All readers take text as text (no type inference: codes such as '01001' must
keep their leading zeros and a sniffed INTEGER would drop them).  Separator,
quote, encoding and header are detected for the statistics files
(``dialect``); lines are read strictly everywhere.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow import schema as S
from odflow.functions import geo
from odflow.sources import dialect, storage


class NoInputFiles(FileNotFoundError):
    pass


def list_files(spark: SparkSession, prefix: str, name_contains: str = "", suffix: str = "") -> list[str]:
    """Full paths of the files under ``prefix`` (any depth, any Hadoop file
    system) whose name contains the text; a prefix without any file at all is
    an error."""
    return list(file_versions(spark, prefix, name_contains, suffix))


def file_versions(spark: SparkSession, prefix: str, name_contains: str = "", suffix: str = "") -> dict[str, tuple[int, int]]:
    """The files of ``list_files``, each with its bytes and modification time."""
    found = storage.listing(spark, prefix) if storage.exists(spark, prefix) else []
    found = [f for f in found if not f[0].rsplit("/", 1)[-1].startswith(("_", "."))]
    if not found:
        raise NoInputFiles(f"no files found in {prefix}")
    return {p: (size, time) for p, size, time in found if name_contains in p.rsplit("/", 1)[-1] and p.endswith(suffix)}


def header_schema(spark: SparkSession, sample: str, sep: str = "|") -> T.StructType:
    """Schema of a separated file from its header line, every column text
    (the empty table made from a sample file).  Only the beginning of the file
    is read, without a job; a header with blank or repeated names, or none
    there, is named by Spark's reader."""
    lines = storage.head(spark, sample, dialect.SAMPLE_BYTES).decode("utf-8-sig", "replace").splitlines()
    rows = dialect.lines_of(lines[0], sep, '"') if lines else []
    names = rows[0] if rows else []
    if not all(names) or len(set(names)) < len(names) or not names:
        names = spark.read.option("header", True).option("sep", sep).csv(sample).columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def empty_like(spark: SparkSession, sample: str, sep: str = "|") -> DataFrame:
    """No rows, with the columns of a sample file."""
    return spark.createDataFrame([], header_schema(spark, sample, sep))


def strict_csv(spark: SparkSession, schema: T.StructType, sep: str, quote: str = '"', encoding: str = "UTF-8",
               header: bool = True, check_header: bool = True) -> DataFrameReader:
    """A reader that fails on a line whose number of fields is not the schema's
    and, unless headers were compared before, on a file whose header is not:
    nothing is padded, cut or shifted."""
    return (
        spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "FAILFAST")
        .option("quote", quote).option("escape", quote).option("encoding", encoding)
        .option("enforceSchema", not check_header)
        .option("columnPruning", False)      # pruned lines are not checked for their number of fields
    )


def read_trip_csv(spark: SparkSession, prefix: str | list[str], name_contains: str = "",
                  schema: T.StructType = S.BRONZE_TRIPS, sep: str = "|", repartition: int | None = None,
                  day_in_name: bool = False) -> DataFrame:
    """All ``*<name_contains>*.csv.gz`` trip files under ``prefix``, one job.

    ``|`` separated, every column text, columns taken by the names in the
    header, whatever their order and however many others the file has.  The
    header of every file is compared with that of the first: a file laid out
    differently, like a line with too few or too many fields, fails the load
    rather than being misread.  A missing column is a ``ContractError``.

    Gzip files are not splittable: each file is one task.  With one file per
    level and day that is already the parallelism and the layout the silver
    table wants (a task writes one (zone, day) directory), so no shuffle is
    added; ``repartition`` spreads a few very large files when needed.  A
    prefix without files is an error; a filter that matches nothing gives an
    empty frame.  A list (e.g. from ``daily_paths``) reads exactly those
    files.  ``day_in_name``: rows of another day than the file's name gives
    fail the load.
    """
    paths = prefix if isinstance(prefix, list) else list_files(spark, prefix, name_contains, ".csv.gz")
    if not paths:
        return spark.createDataFrame([], schema)
    header = header_schema(spark, paths[0], sep)
    missing = [f.name for f in schema.fields if f.name not in header.names]
    if missing:
        raise S.ContractError(f"{paths[0]}: missing columns {missing}")
    reader = strict_csv(spark, header, sep)
    if isinstance(prefix, list):
        df = reader.csv(paths)
    else:
        df = reader.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{name_contains}*.csv.gz").csv(prefix)
    columns = [F.col(f"`{f.name}`") for f in schema.fields]
    if day_in_name:
        wrong = F.regexp_replace("fecha", "-", "") != F.substring("_metadata.file_name", 1, 8)
        columns = [F.when(wrong, F.raise_error(F.concat(F.lit("row of another day in "), F.col("_metadata.file_name"))))
                   .otherwise(F.col("fecha")).alias("fecha") if f.name == "fecha" else F.col(f"`{f.name}`") for f in schema.fields]
    df = df.select(*columns)
    return df.repartition(repartition) if repartition else df


def daily_paths(base: str, suffix: str, start: str, end: str) -> list[str]:
    """Date-stamped file names ``<base>/<yyyyMMdd>_<suffix>.csv.gz`` for a day range."""
    d0, d1 = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    out = []
    d = d0
    while d <= d1:
        out.append(f"{base.rstrip('/')}/{d:%Y%m%d}_{suffix}.csv.gz")
        d += _dt.timedelta(days=1)
    return out


def read_detected(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                  sep: str | None = None, quote: str | None = None) -> DataFrame:
    """Separated text files of any mix of dialects, every value as text.

    The dialect of every file is found from its first bytes (``dialect``);
    files of one dialect are read by one strict scan.  ``columns`` picks
    columns by name, whatever their order and however many others a file has
    (a file without a header has ``column0``, ``column1``, ...); without it all
    files must have the same ones.  A missing column is a ``ContractError``; a
    line with too few or too many fields fails the load with the name of its
    file and its fields.
    """
    paths = path if isinstance(path, list) else list_files(spark, path)
    found = dialect.dialects(spark, paths, tuple(columns or ()), sep, quote)
    wanted = columns
    parts = []
    for d, files_of in found.items():
        wanted = list(d.columns) if wanted is None else wanted
        missing = [c for c in wanted if c not in d.columns]
        if missing or (columns is None and len(d.columns) != len(wanted)):
            raise S.ContractError(f"{files_of[0]}: columns {list(d.columns)}, wanted {wanted}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in d.columns])
        # every file's header was read with its dialect; blank and repeated names are not as written there
        df = strict_csv(spark, schema, d.sep, d.quote, d.encoding, d.header, check_header=False).csv(files_of)
        parts.append(df.select(*[F.col(f"`{c}`") for c in wanted]))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in wanted or []]))
    return reduce(DataFrame.unionByName, parts)


def read_stat_csv(spark: SparkSession, path: str, columns: list[str], sep: str | None = None) -> DataFrame:
    """A statistics CSV with a header, columns picked by name, every value as text.

    The dialect is detected (``sep`` fixes the separator).  No schema inference
    (leading zeros and thousands separators stay as written).  A blank first
    header cell is ``column0``.  Other columns of the file are ignored.
    """
    return read_detected(spark, path, columns, sep)


def read_all_varchar(spark: SparkSession, path: str, schema: T.StructType, sep: str | None = "|") -> DataFrame:
    """Separated text file with a header, the schema's columns picked by name, all as text."""
    df = read_detected(spark, path, [f.name for f in schema.fields], sep)
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) for f in schema.fields])


FEATURE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "geometry",
            T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]),
        ),
    ]
)
COLLECTION = T.StructType([T.StructField("type", T.StringType()), T.StructField("features", T.ArrayType(FEATURE))])


#: Between the text "Feature" of one feature and that of the next: where documents are cut.
FEATURE_TAG = '"Feature"'
#: A document that can be cut: every feature begins with its type.
CUTTABLE = re.compile(r'\{.*"features"\s*:\s*\[\s*(\{\s*"type"\s*:\s*"Feature"|\])', re.S)
#: How a piece ends, white space left out: before the next feature, or with the document.
NEXT_FEATURE, DOCUMENT_END = '},{"type":', r"\}\](,.*)?\}$"


def _features_of_pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Features of FeatureCollection documents, cut at every ``"Feature"``.

    The text source cuts a file into splits like any other, so a document of
    any size is read by many tasks and never held as a whole.  Each piece
    after the first is the rest of one feature, and must end where the next one
    begins or the document ends; one that does not (the text "Feature" inside
    a property, or another order of keys further down) fails the load.
    """
    pieces = spark.read.option("lineSep", FEATURE_TAG).text(paths).select("value", F.col("_metadata.file_path").alias("_file"))
    start = F.left(F.ltrim("value"), F.lit(1))
    end = F.expr("regexp_replace(right(value, 4096), '\\\\s', '')")
    whole = end.endswith(NEXT_FEATURE) | end.rlike(DOCUMENT_END)
    rest = pieces.filter(~start.isin("{", "\ufeff"))
    checked = F.when(whole & (start == ","), F.col("value")).otherwise(
        F.raise_error(F.concat(F.col("_file"), F.lit(": not cut between features: "), F.left("value", F.lit(200)))))
    feature = F.from_json(F.concat(F.lit('{"type":"Feature"'), checked), FEATURE, {"mode": "FAILFAST"})
    return rest.select(feature.alias("f")).select("f.*")


def read_geojson(spark: SparkSession, path: str, properties: list[str], sequence: bool = False,
                 geom_col: str = "geom") -> DataFrame:
    """GeoJSON features as rows: the named properties (as text) plus a geometry.

    ``sequence=False`` reads FeatureCollection documents.  Where features
    begin with their type, as writers put it, documents are cut between
    features and read by many tasks; a document with another order of keys is
    parsed as a whole in one task.  ``sequence=True`` reads one feature per
    line (GeoJSONSeq), which splits like any text file.  Malformed features
    fail the load.  ``coordinates`` is read as raw JSON text so Polygon and
    MultiPolygon share one schema; it is parsed per geometry type.
    """
    if sequence:
        feats = spark.read.schema(FEATURE).option("mode", "FAILFAST").json(path)
    else:
        paths = list_files(spark, path)
        cut = [p for p in paths if CUTTABLE.match(storage.head(spark, p, dialect.SAMPLE_BYTES).decode("utf-8-sig", "replace").lstrip())]
        parts = [_features_of_pieces(spark, cut)] if cut else []
        if len(cut) < len(paths):
            whole = spark.read.schema(COLLECTION).option("multiLine", True).option("mode", "FAILFAST").json([p for p in paths if p not in set(cut)])
            parts.append(whole.select(F.explode("features").alias("f")).select("f.*"))
        feats = reduce(DataFrame.unionByName, parts)
    props = [F.col("properties").getItem(p).alias(p) for p in properties]
    out = feats.select(*props, F.col("geometry.type").alias("_gt"), F.col("geometry.coordinates").alias("_gc"))
    return out.select(*properties, geo.geom_from_geojson("_gt", "_gc").alias(geom_col))


# ------------------------------------------------------------ writers (fixtures, exports)

def feature_json(df: DataFrame, properties: list[str], geom_col: str = "geom") -> DataFrame:
    """One GeoJSON feature per row as text (for GeoJSONSeq files)."""
    geom_json = geo.st_as_geojson(geom_col)
    props = F.to_json(F.struct(*[F.col(p).cast("string").alias(p) for p in properties]))
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geom_json, F.lit("}")
        ).alias("value")
    )
