"""A refresh over a folder of raw files, twice."""

import gzip
import json
from pathlib import Path

import pytest

from territory import schemas
from territory.operators import incremental, quality
from territory.plans import serving, warehouse
from territory.sources import records
from territory.session import folder_bytes, scale_conf

HEADER = ",".join(schemas.RAW_COLUMNS["sales"])


def lot(key, day, code, price, area="50", rooms="1"):
    return f"{key},1,{day},Vente,{code},{code},{code[:2]},{code[:2]}000,Appartement,{rooms},{area},,{price},48.8,2.3"


def write_raw(folder, years):
    for year in years:
        for code in ("75101", "92001"):
            lines = [lot(f"{code}-{year}-{i}", f"{year}-02-0{i + 1}", code, 100000 * (i + 1)) for i in range(6)]
            content = "\n".join([HEADER, *lines]) + "\n"
            name = folder / f"dvf_plus_{code[:2]}_{year}.csv"
            if code == "75101":
                name.with_suffix(".csv.gz").write_bytes(gzip.compress(content.encode()))
            else:
                name.write_text(content)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    write_raw(folder, ["2024"])
    (folder / "cog_communes_2024.csv").write_text(
        "TYPECOM,COM,REG,DEP,LIBELLE,COMPARENT\nARM,75101,11,75,Paris 1er,75056\nCOM,92001,11,92,Antony,\n"
    )
    (folder / "FILO2021_DEC_COM.csv").write_text(
        "CODGEO;Q121;Q221;Q321;D121;D921;GI21;PMIMP21;NBMEN21\n75101;15000;30000;45000;10000;60000;0,3;60;10\n"
        "92001;14000;25000,5;40000;9000;50000;0,3;55,5;20\n"
    )
    (folder / "base-pop-historiques.csv").write_text("CODGEO,LIBGEO,PMUN2021,PMUN2015\n75101,Paris,1000,900\n92001,Antony,2000,\n")
    (folder / "TD_POP1B_2021.csv").write_text("CODGEO;SEXE;AGED100;NB\n75101;1;030;10\n75101;2;070;30\n92001;1;030;5\n")
    (folder / "loyers_communes_2025.csv").write_bytes(
        "INSEE_C;LIBGEO;DEP;loypredm2;lwr.IPm2;upr.IPm2;TYPPRED;nbobs_com\n75101;Évry;75;30,5;29;32;commune;\n".encode("latin-1")
    )
    (folder / "delinquance_communes.csv.gz").write_bytes(gzip.compress(
        "CODGEO_2025;annee;indicateur;est_diffuse;nombre;taux_pour_mille;insee_pop\n75101;2024;Vols avec armes;diff;5;5,0;1000\n92001;2024;Vols\n".encode()
    ))
    square = [[[2.00001, 48.0], [3.0, 48.0], [3.0, 49.0], [2.0, 49.0], [2.00001, 48.0]]]
    for name, codes in (("communes", ["75056"]), ("arrondissements", ["75101"])):
        (folder / f"{name}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"code": c, "nom": "Paris", "x": 1}, "geometry": {"type": "Polygon", "coordinates": square}}
            for c in codes]}))
    (folder / "counter_traffic.json").write_text(json.dumps({"results": [
        {"id_compteur": "1", "nom_compteur": "A", "total_passages": 5}, {"id_compteur": "2", "nom_compteur": "B", "total_passages": 9},
        {"id_compteur": "3", "nom_compteur": "C", "total_passages": 7}]}))
    (folder / "counter_positions.json").write_text(json.dumps({"results": [
        {"id_compteur": "1", "coordinates": {"lat": 1.0, "lon": 2.0}}, {"id_compteur": "1", "coordinates": {"lat": 3.0, "lon": 4.0}},
        {"id_compteur": "2"}, {"id_compteur": "3", "coordinates": {"lat": 5.0, "lon": 6.0}}]}))
    (folder / "velib_stations.json").write_text(json.dumps({"data": {"stations": [
        {"station_id": 7, "name": "A", "lat": 48.5, "lon": 2.5, "capacity": 30},
        {"station_id": 8, "name": "B", "lat": 50.5, "lon": 2.5, "capacity": 30}]}}))
    stop = {"stop_name": "N", "stop_lat": "48.5", "stop_lon": "2.5", "mode": "Metro", "shortname": "1"}
    (folder / "stops_metro.json").write_text(json.dumps({"results": [stop, stop | {"shortname": "2"}]}))
    (folder / "cycle_paths.json").write_text(json.dumps({"results": [{"arrondissement": "1", "longueur_m": 12345.0}]}))
    return folder


def test_two_refreshes(spark, folder, tmp_path):
    target = str(tmp_path / "warehouse")
    first = {r["table_name"]: r["n"] for r in warehouse.refresh(spark, str(folder), target).collect()}
    assert len(first) == 45 and not any(first.values())
    tables = {n: spark.read.parquet(f"{target}/v1/tables/{n}") for n in ("accessibility", "velib_stations", "metro_stations", "cyclable_paris")}
    assert sorted((r["code_commune"], r["nb_ventes"], r["taux_delinquance_pour_mille"]) for r in tables["accessibility"].collect()) == [
        ("75101", 6, 5.0), ("92001", 6, None)
    ]
    assert tables["velib_stations"].first()["nb_stations"] == 1
    assert tables["metro_stations"].first()["nb_lignes_uniques"] == 2
    assert tables["cyclable_paris"].first()["longueur_km"] == 12.3
    assert spark.read.csv(f"{target}/v1/csv/tension", header=True).count() == 2
    counters = spark.read.parquet(f"{target}/v1/tables/comptage_velo_paris")
    assert sorted(tuple(r) for r in counters.collect()) == [("A", 3.0, 4.0, 5), ("C", 5.0, 6.0, 7)]
    assert spark.read.parquet(f"{target}/v1/tables/department_outlines").count() == 4
    drawn = records.read_geojson(spark, f"{target}/v1/geojson_departments", lines=True).collect()
    assert [(r.code, r.nom, len(r.geom), len(r.geom[0][0])) for r in drawn] == [("75", "Paris", 1, 5)]
    city = records.read_geojson(spark, f"{target}/v1/geojson/zone=paris_arrondissements", lines=True)
    assert [(r["code"], r["geom"][0][0][0]) for r in city.collect()] == [("75101", [2.0, 48.0])]
    write_raw(folder, ["2025"])
    warehouse.refresh(spark, str(folder), target, version=2)
    evolution = spark.read.parquet(f"{target}/v2/tables/evolution")
    assert sorted((r["annee"], r["variation_prix_m2_pct"]) for r in evolution.filter("code_commune = '75101'").collect()) == [
        (2024, None), (2025, 0.0)
    ]
    assert incremental.read_version(spark, f"{target}/sales", 2).count() == 24
    cards = serving.Tables(
        accessibility=spark.read.parquet(f"{target}/v2/tables/accessibility"),
        zones=spark.read.parquet(f"{target}/v2/tables/zones"), evolution=evolution,
        crime_detail=spark.read.parquet(f"{target}/v2/tables/crime_detail"),
        city_rooms=spark.read.parquet(f"{target}/v2/tables/city_rooms"),
        diplomas=spark.read.parquet(f"{target}/v2/tables/diplomas"),
        transit=tables["metro_stations"], cycle=tables["cyclable_paris"],
    )
    assert serving.city_studio_rent(cards).collect()[0][1] == 1525.0
    assert serving.city_transit(cards).count() == 1


def test_bad_input_is_not_published(spark, folder, tmp_path):
    target = str(tmp_path / "warehouse")
    warehouse.refresh(spark, str(folder), target)
    before = sorted((p, p.stat().st_mtime_ns) for p in Path(target, "v1").rglob("*"))
    rents = folder / "loyers_communes_2025.csv"
    good = rents.read_bytes()
    rents.write_bytes(good.replace(b";30,5;", b";-30,5;"))
    with pytest.raises(quality.QualityError) as bad:
        warehouse.refresh(spark, str(folder), target, version=2)
    rents.write_bytes(good)
    assert "rent_positive" in bad.value.violations
    assert not (Path(target) / "v2" / "tables").exists()
    # The refused version of the sales is gone: a corrected delivery finds the old watermark.
    assert not (Path(target) / "sales" / "manifest" / "v2").exists() and (Path(target) / "sales" / "manifest" / "v1").exists()
    assert sorted((p, p.stat().st_mtime_ns) for p in Path(target, "v1").rglob("*")) == before


def test_stale_sales_are_refused(spark, folder, tmp_path):
    with pytest.raises(quality.QualityError, match="sales_fresh") as old:
        warehouse.refresh(spark, str(folder), str(tmp_path / "warehouse"), today="2031-01-01")
    # Files of this day are too old by then as well; sources without a file are not judged.
    assert "income_fresh" in old.value.violations and "diplomas_fresh" not in old.value.violations


def test_settings_follow_the_input(spark, folder):
    assert folder_bytes(spark, str(folder)) > 0
    small, large = scale_conf(10**9, 8), scale_conf(100 * 10**12, 4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(large["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (192 << 20))
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 256 << 20
