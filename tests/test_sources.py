import gzip
import json
import os

import pytest

from odflow import schema as S
from odflow.sources import files


def test_trip_csv_keeps_leading_zeros_and_filters_names(spark, scratch):
    d = os.path.join(scratch, "trips", "2023", "01")
    os.makedirs(d)
    body = "fecha|periodo|origen|destino|viajes|viajes_km\n2023-01-01|00|01001|01002|1.5|2.25\n"
    for name in ("20230101_Viajes_distritos.csv.gz", "20230102_Viajes_distritos.csv.gz", "20230101_Viajes_GAU.csv.gz"):
        with gzip.open(os.path.join(d, name), "wt") as f:
            f.write(body)
    df = files.read_trip_csv(spark, os.path.join(scratch, "trips"), "Viajes_distritos")
    rows = df.collect()
    assert len(rows) == 2 and rows[0].periodo == "00" and rows[0].origen == "01001"
    assert files.read_trip_csv(spark, os.path.join(scratch, "trips"), "Viajes_municipios").count() == 0


def test_trip_csv_missing_prefix_is_an_error(spark, scratch):
    with pytest.raises(files.NoInputFiles):
        files.read_trip_csv(spark, os.path.join(scratch, "nothing-here"), "Viajes")


def test_daily_paths():
    p = files.daily_paths("s3a://b/x", "Viajes_distritos", "2023-01-30", "2023-02-01")
    assert p == ["s3a://b/x/20230130_Viajes_distritos.csv.gz", "s3a://b/x/20230131_Viajes_distritos.csv.gz",
                 "s3a://b/x/20230201_Viajes_distritos.csv.gz"]


def test_stat_csv_blank_first_header(spark, scratch):
    p = os.path.join(scratch, "pob.csv")
    with open(p, "w") as f:
        f.write(',Total\n44001 Ababuj,"1,234"\n')
    df = files.read_stat_csv(spark, p, ["column0", "Total"])
    assert [tuple(r) for r in df.collect()] == [("44001 Ababuj", "1,234")]


def test_relations_all_text(spark, scratch):
    p = os.path.join(scratch, "rel.csv")
    with open(p, "w") as f:
        f.write("municipio_mitma|municipio_ine|distrito_mitma|distrito_ine|gau_mitma\n01001|01001|0100101|0100101|NA\n")
    r = files.read_all_varchar(spark, p, S.BRONZE_RELACIONES).first()
    assert r.municipio_ine == "01001" and r.gau_mitma == "NA"


def _feature(fid, name, gtype, coords, extra=None):
    props = {"id": fid, "name": name}
    props.update(extra or {})
    return {"type": "Feature", "properties": props, "geometry": {"type": gtype, "coordinates": coords}}


def test_geojson_collection_and_sequence(spark, scratch):
    feats = [
        _feature("01001", "Uno", "Polygon", [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]),
        _feature(2, "Dos", "MultiPolygon", [[[[0, 0], [2, 0], [2, 2], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]],
                 {"Codigo": 46}),
    ]
    coll = os.path.join(scratch, "c.geojson")
    with open(coll, "w") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f, indent=2)
    seq = os.path.join(scratch, "s.geojsonl")
    with open(seq, "w") as f:
        f.write("\n".join(json.dumps(x) for x in feats))
    for path, sequence in ((coll, False), (seq, True)):
        df = files.read_geojson(spark, path, ["id", "name", "Codigo"], sequence=sequence)
        got = sorted((r.id, r.name, r.Codigo, r.geom.kind, len(r.geom.polys), r.geom.xmax) for r in df.collect())
        assert got == [("01001", "Uno", None, "Polygon", 1, 1.0), ("2", "Dos", "46", "MultiPolygon", 2, 6.0)]


def test_feature_json_round_trip(spark, scratch):
    from odflow.functions import geo
    src = spark.createDataFrame([("Z1", "A", "POLYGON((0 0, 3 0, 3 3, 0 0))")], "id string, name string, w string") \
        .select("id", "name", geo.geom_from_wkt("w").alias("geom"))
    out = os.path.join(scratch, "geo")
    files.feature_json(src, ["id", "name"]).write.text(out)
    back = files.read_geojson(spark, out, ["id", "name"], sequence=True).first()
    assert back.geom.polys == src.first().geom.polys


def test_trip_csv_from_daily_path_list(spark, scratch):
    d = os.path.join(scratch, "t")
    os.makedirs(d)
    for day in ("20230101", "20230102", "20230103"):
        with gzip.open(os.path.join(d, f"{day}_Viajes_GAU.csv.gz"), "wt") as f:
            f.write(f"fecha|periodo|origen|destino|viajes|viajes_km\n{day}|00|1|2|1|1\n")
    paths = files.daily_paths(d, "Viajes_GAU", "2023-01-02", "2023-01-03")
    assert sorted(r.fecha for r in files.read_trip_csv(spark, paths).collect()) == ["20230102", "20230103"]


HEADER = "fecha|periodo|origen|destino|viajes|viajes_km"


def _gz(path, header, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join([header, *lines]) + "\n")


def test_trip_csv_takes_columns_by_name(spark, scratch):
    _gz(f"{scratch}/t/20230101_Viajes_a.csv.gz", "extra|fecha|periodo|destino|origen|viajes|viajes_km|renta", "e|20230101|08|D|O|1.5|2.5|r")
    df = files.read_trip_csv(spark, f"{scratch}/t", "Viajes")
    assert df.columns == HEADER.split("|")
    assert tuple(df.first()) == ("20230101", "08", "O", "D", "1.5", "2.5")
    assert tuple(df.select("viajes", "viajes_km").first()) == ("1.5", "2.5")


def test_trip_csv_missing_column_is_an_error(spark, scratch):
    _gz(f"{scratch}/t/20230101_Viajes_a.csv.gz", HEADER.replace("|viajes_km", ""), "20230101|08|O|D|1")
    with pytest.raises(S.ContractError, match="viajes_km"):
        files.read_trip_csv(spark, f"{scratch}/t", "Viajes")


@pytest.mark.parametrize("line", ["20230101|08|O|D|1", "20230101|08|O|D|1|2|3"])
def test_trip_csv_lines_of_another_length_fail(spark, scratch, line):
    _gz(f"{scratch}/t/20230101_Viajes_a.csv.gz", HEADER, "20230101|08|O|D|1|2", line)
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        files.read_trip_csv(spark, f"{scratch}/t", "Viajes").collect()


def test_trip_csv_files_laid_out_differently_fail(spark, scratch):
    _gz(f"{scratch}/t/20230101_Viajes_a.csv.gz", HEADER, "20230101|08|O|D|1|2")
    _gz(f"{scratch}/t/20230102_Viajes_a.csv.gz", HEADER.replace("origen|destino", "destino|origen"), "20230102|08|D|O|1|2")
    with pytest.raises(Exception):
        files.read_trip_csv(spark, f"{scratch}/t", "Viajes").collect()


def test_trip_csv_empty_folder_is_an_error(spark, scratch):
    os.makedirs(f"{scratch}/none")
    with pytest.raises(files.NoInputFiles):
        files.read_trip_csv(spark, f"{scratch}/none", "Viajes")


def test_empty_table_from_a_sample_file(spark, scratch):
    _gz(f"{scratch}/t/20230101_Viajes_a.csv.gz", "a|b|c", "1|2|3")
    df = files.empty_like(spark, f"{scratch}/t/20230101_Viajes_a.csv.gz")
    assert df.dtypes == [("a", "string"), ("b", "string"), ("c", "string")] and df.count() == 0


def _collection(path, feats, indent=None, extra=""):
    with open(path, "w") as f:
        text = json.dumps({"type": "FeatureCollection", "name": "x", "features": feats}, indent=indent, ensure_ascii=False)
        f.write(text[:-1] + extra + text[-1:])


@pytest.mark.parametrize("indent", [None, 2, 8])
@pytest.mark.parametrize("extra", ["", ', "bbox": [0, 0, 1, 1]'])
def test_one_document_is_read_by_many_tasks(spark, scratch, indent, extra):
    r = range(400)
    square = lambda i: [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 1], [i, 0]]]
    feats = [_feature(f"{i:05d}", f'Ñ "{i}" }},{{"type":', "Polygon", square(i)) for i in r]
    feats[7]["geometry"] = None
    path = os.path.join(scratch, "c.geojson")
    _collection(path, feats, indent, extra)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = files.read_geojson(spark, path, ["id", "name"])
        assert df.rdd.getNumPartitions() > 5
        rows = {x.id: x for x in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert set(rows) == {f"{i:05d}" for i in r} and all(rows[f"{i:05d}"].name.startswith(f'Ñ "{i}"') for i in r)
    assert rows["00007"].geom is None or rows["00007"].geom.edges is None
    assert rows["00399"].geom.xmax == 400.0


def test_documents_that_cannot_be_cut(spark, scratch):
    square = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
    other = [{"properties": {"id": str(i)}, "geometry": {"type": "Polygon", "coordinates": square}, "type": "Feature"} for i in range(3)]
    os.makedirs(f"{scratch}/d")
    _collection(f"{scratch}/d/other.geojson", other)                       # type last: parsed whole
    _collection(f"{scratch}/d/cut.geojson", [_feature("a", "A", "Polygon", square)])
    _collection(f"{scratch}/d/none.geojson", [])
    assert sorted(r.id for r in files.read_geojson(spark, f"{scratch}/d", ["id"]).collect()) == ["0", "1", "2", "a"]
    mixed = [_feature("a", "A", "Polygon", square), *other]                # another order further down
    _collection(f"{scratch}/mixed.geojson", mixed)
    inside = [_feature("a", "A", "Polygon", square, {"kind": "Feature"}), _feature("b", "B", "Polygon", square)]
    _collection(f"{scratch}/inside.geojson", inside)                       # the tag inside a property
    for name in ("mixed", "inside"):
        with pytest.raises(Exception):
            files.read_geojson(spark, f"{scratch}/{name}.geojson", ["id"]).collect()
    with open(f"{scratch}/broken.geojson", "w") as f:
        f.write('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": "1"}, "geometry": nul}]}')
    with pytest.raises(Exception):
        files.read_geojson(spark, f"{scratch}/broken.geojson", ["id"]).collect()
