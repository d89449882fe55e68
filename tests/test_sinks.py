import json
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from territory import sinks
from territory.operators.geo import GEOMETRY_TYPE
from territory.operators.storage import checkpoint_folder, materialise, temporary_copies
from territory.sources.records import read_geojson


def test_replace_table_and_view(spark):
    sinks.replace_table(spark.range(3), "raw_table_test")
    assert sinks.replace_table(spark.range(5), "raw_table_test").count() == 5
    assert spark.table("raw_table_test").count() == 5
    spark.sql("drop table raw_table_test")
    sinks.as_view(spark.range(2), "view_test")
    assert spark.table("view_test").count() == 2


def test_publish_counts_rows(spark, tmp_path):
    counts = sinks.publish({"a": spark.range(4), "b": spark.range(2)}, str(tmp_path / "out"))
    assert {r["table_name"]: r["n"] for r in counts.collect()} == {"a": 4, "b": 2}


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([("a,b", None), ("c", 1.5)], "k string, v double").coalesce(1)
    sinks.export_csv(df, str(tmp_path / "csv"))
    (part,) = (tmp_path / "csv").glob("part-*")
    assert part.read_text().splitlines() == ["k,v", '"a,b",', "c,1.5"]


def features(spark, n=1):
    codes = ["75101", "75102", "92001", "93001", "77001", "95001"]
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    data = [(f"{c}{i if n > 1 else ''}", "L'Haÿ", [[ring]] if c != "92001" else [[ring], [ring]]) for c in codes for i in range(n)]
    return spark.createDataFrame(data, f"code string, nom string, geom {GEOMETRY_TYPE}")


def test_zone_documents(spark, tmp_path):
    sinks.write_geojson_by_zone(features(spark), str(tmp_path / "geo"), documents=True)
    codes = {}
    for folder in Path(tmp_path / "geo").glob("zone=*"):
        lines = [line for f in folder.glob("part-*") for line in f.read_text().splitlines()]
        assert len(lines) == 1
        document = json.loads(lines[0])
        assert document["type"] == "FeatureCollection"
        codes[folder.name[5:]] = [f["properties"]["code"] for f in document["features"]]
    assert codes == {
        "idf_communes": ["75101", "75102", "77001", "92001", "93001", "95001"],
        "paris_arrondissements": ["75101", "75102"],
        "petite_couronne": ["92001", "93001"],
        "petite_couronne_plus_paris": ["75101", "75102", "92001", "93001"],
        "grande_couronne": ["77001", "95001"],
    }
    back = read_geojson(spark, str(tmp_path / "geo" / "zone=petite_couronne"))
    assert {r["code"]: len(r["geom"]) for r in back.collect()} == {"92001": 2, "93001": 1}


@pytest.mark.parametrize("documents", [False, True])
def test_every_feature_of_a_large_zone_comes_back(spark, tmp_path, documents):
    path = str(tmp_path / "geo")
    written = features(spark, 1200)
    sinks.write_geojson_by_zone(written.repartition(5), path, documents=documents)
    back = read_geojson(spark, f"{path}/zone=idf_communes", lines=not documents)
    assert back.count() == written.count() == 7200
    assert back.exceptAll(written).isEmpty()


def test_outlines_hold_every_segment(spark, tmp_path):
    segments = spark.range(2500).selectExpr("if(id % 5 = 0, '75', '92') code_dep", "double(id) x1", "0D y1", "double(id) x2", "1D y2")
    sinks.write_outlines(segments, str(tmp_path / "lines"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "lines")).collect()]
    assert {f["properties"]["code"] for f in lines} == {"75", "92"}
    assert sum(len(f["geometry"]["coordinates"]) for f in lines) == 2500
    assert all(f["geometry"]["type"] == "MultiLineString" for f in lines)


def test_materialise_uses_the_session_folder(spark):
    assert checkpoint_folder(spark).startswith("file:" + spark.conf.get("spark.checkpoint.dir")) or \
        checkpoint_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = materialise(spark.range(10).withColumn("x", F.col("id") * 2))
    assert kept.agg(F.sum("x")).first()[0] == 90
    assert checkpoint_folder(spark).removeprefix("file:") in kept.inputFiles()[0]


def test_temporary_copies_are_deleted(spark):
    kept = materialise(spark.range(3))
    with temporary_copies(spark):
        gone = materialise(spark.range(5)).inputFiles()[0].removeprefix("file:").replace("///", "/")
        assert Path(gone).exists()
    assert not Path(gone).parent.exists() and kept.count() == 3


def test_bucketed_table_needs_no_shuffle_per_key(spark):
    from conftest import plan_of
    from territory.operators.dedup import keep_largest

    df = spark.range(200).select((F.col("id") % 20).alias("key"), F.col("id").cast("double").alias("area"))
    stored = sinks.replace_table(df, "bucketed_test", "key", 4)
    kept = keep_largest(stored, "key", "area")
    assert "Exchange" not in plan_of(kept)
    assert kept.agg(F.sum("area")).first()[0] == sum(range(180, 200))
    spark.sql("drop table bucketed_test")


def test_a_zone_beyond_the_size_of_a_document_comes_as_several(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "DOCUMENT_BYTES", 40_000)
    path = str(tmp_path / "geo")
    written = features(spark, 400)
    sinks.write_geojson_by_zone(written, path, documents=True)
    files = list(Path(path).glob("zone=idf_communes/part-*"))
    documents = [json.loads(f.read_text()) for f in files]
    assert len(files) > 5 and max(f.stat().st_size for f in files) < 80_000
    assert sum(len(d["features"]) for d in documents) == 2400
    assert read_geojson(spark, f"{path}/zone=idf_communes").exceptAll(written).isEmpty()


def test_a_document_is_read_once(spark, tmp_path):
    document = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[i, 0.5], [1, 0], [1, 1], [i, 0.5]]]}, "properties": {"code": str(i), "nom": "é"}}
        for i in range(3)
    ]}
    (tmp_path / "d.geojson").write_text("﻿" + json.dumps(document, indent=1, ensure_ascii=False))
    back = read_geojson(spark, str(tmp_path / "d.geojson"))
    assert sorted((r["code"], r["nom"], r["geom"][0][0][0]) for r in back.collect()) == [(str(i), "é", [float(i), 0.5]) for i in range(3)]
    assert "Scan json" not in back._jdf.queryExecution().executedPlan().toString()
