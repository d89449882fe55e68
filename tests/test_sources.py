import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from territory import schemas
from territory.sources import records, text


def write(path, content, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content.encode(encoding))
    return str(path)


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


def test_every_column_is_text(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'COM,LIBELLE\n01001,"L\'Île, ""la"" grande"\n')
    df = text.read_text_table(spark, path)
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert tuples(df) == [("01001", 'L\'Île, "la" grande')]


def test_gzip_and_spread(spark, tmp_path):
    path = tmp_path / "a.csv.gz"
    path.write_bytes(gzip.compress(b"x;y\n1;2\n3;4\n"))
    df = text.read_text_table(spark, str(path), sep=";", spread=3)
    assert tuples(df) == [("1", "2"), ("3", "4")]


def test_legacy_encoding_and_dotted_names(spark, tmp_path):
    path = write(tmp_path / "r.csv", "INSEE_C;LIBGEO;lwr.IPm2\n95001;Évry;9,5\n", "latin-1")
    df = text.read_text_table(spark, path, sep=";", encoding="ISO-8859-1")
    assert [tuple(r) for r in df.select("LIBGEO", "`lwr.IPm2`").collect()] == [("Évry", "9,5")]


def test_ragged_rows_are_padded(spark, tmp_path):
    path = write(tmp_path / "c.csv", "a;b;c\n1;2;3\n4;5\n")
    assert tuples(text.read_text_table(spark, path, sep=";").fillna("-")) == [("1", "2", "3"), ("4", "5", "-")]


def test_many_files_by_name(spark, tmp_path):
    one = write(tmp_path / "1.csv", "x,y\n1,2\nbroken,row,of,five,fields\n")
    two = write(tmp_path / "2.csv", "y,x,z\n20,10,30\n")
    three = tmp_path / "3.csv.gz"
    three.write_bytes(gzip.compress(b"x,y\n5,6\n"))
    df = text.read_many_by_name(spark, [one, two, str(three)])
    assert tuples(df.select("x", "y", "z").fillna("-")) == [("1", "2", "-"), ("10", "20", "30"), ("5", "6", "-")]
    # A malformed row is skipped also when few columns are read.
    assert sorted(r["x"] for r in df.select("x").collect()) == ["1", "10", "5"]


def test_files_are_grouped_by_header(spark, tmp_path):
    paths = [write(tmp_path / f"{i}.csv", ("a,b" if i % 2 else "b,a") + "\n1,2\n") for i in range(6)]
    assert [len(g) for g in text.header_groups(spark, paths)] == [3, 3]


def test_optional_source(spark, tmp_path):
    df = text.read_raw(spark, "income", str(tmp_path / "none.csv"))
    assert df.count() == 0 and df.columns == list(schemas.RAW_COLUMNS["income"])


def test_plain_file_before_gzip(spark, tmp_path):
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(b"CODGEO_2025;annee\nz;1\n"))
    both = (str(tmp_path / "c.csv"), str(tmp_path / "c.csv.gz"))
    assert text.read_raw(spark, "crime", *both).first()[0] == "z"
    write(tmp_path / "c.csv", "CODGEO_2025;annee\nplain;1\n")
    assert text.read_raw(spark, "crime", *both).first()[0] == "plain"


def test_typed_csv(spark, tmp_path):
    path = write(tmp_path / "d.csv", "CODGEO;P21\n01001;12.5\n01002;\n")
    schema = T.StructType([T.StructField("CODGEO", T.StringType()), T.StructField("P21", T.DoubleType())])
    assert [tuple(r) for r in text.read_typed_csv(spark, path, schema).collect()] == [("01001", 12.5), ("01002", None)]


def test_zone_seed(spark, tmp_path):
    assert text.zone_seed(spark).count() == 8
    path = write(tmp_path / "z.csv", "code_departement,zone_idf\n01,Paris\n")
    assert text.zone_seed(spark, path).first()["code_departement"] == "01"


def test_records(spark, tmp_path):
    stations = [
        {"stationCode": "16107", "station_id": 1, "name": "A", "lat": 48.8, "lon": 2.3, "capacity": 35},
        {"station_id": 213, "name": "B", "lat": 48.9, "lon": 2.4, "capacity": 20},
    ]
    path = write(tmp_path / "s.json", json.dumps({"data": {"stations": stations}}, indent=1))
    assert tuples(records.read_stations(spark, path).select("code", "capacity")) == [("16107", 35), ("213", 20)]
    counters = [{"id_compteur": "1", "coordinates": {"lat": 1.5, "lon": 2.5}}, {"id_compteur": "2"}]
    path = write(tmp_path / "c.json", json.dumps({"results": counters}))
    rows = records.read_records(spark, path, schemas.COUNTER_SCHEMA).select("id_compteur", "coordinates.lat")
    assert {r[0]: r[1] for r in rows.collect()} == {"1": 1.5, "2": None}


def test_stops_keep_their_order(spark, tmp_path):
    def stop(name, lat, mode):
        return {"stop_name": name, "stop_lat": lat, "stop_lon": "2.0", "mode": mode, "shortname": mode[0]}

    metro = write(tmp_path / "m.json", json.dumps({"results": [stop("N", "1.0", "Metro"), stop("N", "2.0", "Metro")]}))
    rer = write(tmp_path / "r.json", json.dumps({"results": [stop("N", "3.0", "RER"), stop("R", "4.0", "RER")]}))
    from territory.plans.mobility import station_lines

    got = station_lines(records.read_stops(spark, [metro, rer]))
    assert tuples(got.select("name", "lat", "line")) == [("N", 1.0, "M"), ("N", 1.0, "R"), ("R", 4.0, "R")]


FEATURES = [
    {"type": "Feature", "properties": {"code": "1", "nom": "P", "extra": 1},
     "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1.5], [0, 0]]]}},
    {"type": "Feature", "properties": {"code": "2", "nom": "M"},
     "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
]


@pytest.mark.parametrize("lines", [False, True])
def test_geojson(spark, tmp_path, lines):
    if lines:
        content = "\n".join(json.dumps(f) for f in FEATURES)
    else:
        content = json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=2)
    df = records.read_geojson(spark, write(tmp_path / "g.json", content), lines=lines)
    got = {r["code"]: r["geom"] for r in df.collect()}
    assert got["1"] == [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.5], [0.0, 0.0]]]]
    assert len(got["2"]) == 2


def test_union_by_name(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "y int, z int")
    assert tuples(text.union_by_name([a, b]).fillna(0)) == [(0, 3, 4), (1, 2, 0)]


def test_separators_are_told(spark, tmp_path):
    from territory.sources import text

    assert text.separator_of(["a;b;c", "1;2,5;3", "4;5,1;6"]) == ";"
    assert text.separator_of(['a|b', '"x|y;z";1|2', "3|4"]) == "|"
    assert text.separator_of(['"a,b";"c,d"', '"1,2";"3,4"']) == ";"
    assert text.separator_of(["a\tb", "1\t2"]) == "\t"
    # Ragged rows count less, they do not decide; among equals the wider one, then the order of the list.
    assert text.separator_of(["a;b;c", "1;2;3", "1;2"]) == ";"
    assert text.separator_of(["a,b;c", "1,2;3"]) == ","
    assert text.separator_of(["a,b;c;d", "1,2;3;4"]) == ";"
    assert text.separator_of(["alone", "1"]) == text.separator_of([]) == text.separator_of(["", " "]) == ","
    for name, data in {
        "bom.csv": b"\xef\xbb\xbfa;b\n1;x\n", "gz.csv.gz": gzip.compress(b"a|b\n1|x\n"), "one.csv": b"a\n1\n", "none.csv": b"",
    }.items():
        (tmp_path / name).write_bytes(data)
    assert text.detect_separator(spark, str(tmp_path / "bom.csv")) == ";"
    assert text.detect_separator(spark, str(tmp_path / "gz.csv.gz")) == "|"
    assert text.detect_separator(spark, str(tmp_path / "one.csv")) == text.detect_separator(spark, str(tmp_path / "none.csv")) == ","
    (tmp_path / "latin.csv").write_bytes("clé;libellé\n1;é,è\n2;ù,à\n".encode("latin-1"))
    back = text.read_text_table(spark, str(tmp_path / "latin.csv"), sep=None, encoding="ISO-8859-1")
    assert [tuple(r) for r in back.collect()] == [("1", "é,è"), ("2", "ù,à")]
    many = text.read_many_by_name(spark, [str(tmp_path / "latin.csv")], sep=None, encoding="ISO-8859-1")
    assert many.columns == ["clé", "libellé"]
