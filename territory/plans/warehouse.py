"""One refresh: raw files in, stored result tables out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from territory import schemas, sinks
from territory import settings as S
from territory.functions import clean as C
from territory.operators import geo, incremental, quality, rings
from territory.operators.storage import materialise, temporary_copies
from territory.plans import mobility, staging
from territory.plans.build import build_models
from territory.sources import records, text

# File names of the raw tables; plain text is preferred to its gzip copy.
FILES = {
    "sale_stats": "stats_dvf.csv",
    "communes": "cog_communes_2024.csv",
    "income": "FILO2021_DEC_COM.csv",
    "population": "base-pop-historiques.csv",
    "population_age": "TD_POP1B_2021.csv",
    "rents": "loyers_communes_2025.csv",
    "crime": "delinquance_communes.csv",
    "diplomas": "diplomes_formation_2021.csv",
}
YEARS = ("2021", "2022", "2023", "2024", "2025")


def raw_sales(
    spark: SparkSession,
    folder: str,
    years: Sequence[str] = YEARS,
    departments: Sequence[str] = S.DEPARTMENTS,
) -> DataFrame:
    """Sales files of every year and department found, by column name."""
    found = []
    for year in years:
        for department in departments:
            name = f"{folder}/dvf_plus_{department}_{year}.csv"
            path = text.first_existing(spark, name, f"{name}.gz")
            if path:
                found.append(path)
    if not found:
        print("sales: no file, skipped")
        return spark.createDataFrame([], schemas.raw_schema("sales"))
    empty = spark.createDataFrame([], schemas.raw_schema("sales"))
    return text.union_by_name([empty, text.read_many_by_name(spark, found, spread=text.spread_of(spark, found), **schemas.RAW_FORMATS["sales"])])


def raw_tables(
    spark: SparkSession, folder: str, files: Mapping[str, str] | None = None, **scope
) -> dict[str, DataFrame]:
    """Raw tables by name; a missing file gives an empty table. ``files`` renames some."""
    tables = {
        table: text.read_raw(spark, table, f"{folder}/{name}", f"{folder}/{name}.gz")
        for table, name in {**FILES, **(files or {})}.items()
    }
    return tables | {"sales": raw_sales(spark, folder, **scope)}


def source_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """Path of the file of each source that carries no date of its own; sources without a file are left out."""
    found = {table: text.first_existing(spark, f"{folder}/{FILES[table]}", f"{folder}/{FILES[table]}.gz") for table in quality.FILE_AGES}
    return {table: path for table, path in found.items() if path}


def boundaries(spark: SparkSession, folder: str) -> DataFrame | None:
    """Commune boundaries with the city's districts in place of the city, from
    features by line, from one merged file or from the two it is made of."""
    by_line = f"{folder}/idf_communes.geojsonl"
    if text.path_exists(spark, by_line):
        return records.read_geojson(spark, by_line, lines=True)
    merged = f"{folder}/idf_communes.geojson"
    parts = f"{folder}/communes.geojson", f"{folder}/arrondissements.geojson"
    if text.path_exists(spark, merged):
        return records.read_geojson(spark, merged)
    if all(text.path_exists(spark, part) for part in parts):
        return geo.merge_features(*[records.read_geojson(spark, part) for part in parts])
    print("boundaries: no file, skipped")
    return None


def outlines(areas: DataFrame) -> DataFrame:
    """Boundary segments of each department."""
    return geo.dissolve_boundary(areas.withColumn("code_dep", C.department_of("code")), "code_dep")


def department_rings(areas: DataFrame) -> DataFrame:
    """One multipolygon per department, dissolved from its communes."""
    return rings.outlines(areas.withColumn("code_dep", C.department_of("code")), "code_dep")


def mobility_tables(spark: SparkSession, folder: str, areas: DataFrame) -> dict[str, DataFrame]:
    """Mobility tables for the record files present."""
    def path(name: str) -> str | None:
        return text.first_existing(spark, f"{folder}/{name}")

    tables = {}
    if stations := path("velib_stations.json"):
        rows = records.read_stations(spark, stations)
        tables["velib_stations"] = mobility.bike_density(rows, areas)
        tables["velib_stations_geo"] = mobility.tag_points(rows.drop("code"), areas)
    stops = [p for p in (path("stops_metro.json"), path("stops_rer.json")) if p]
    if stops:
        tables["metro_stations"] = mobility.transit_density(records.read_stops(spark, stops), areas)
    if paths := path("cycle_paths.json"):
        rows = records.read_records(spark, paths, schemas.CYCLE_PATH_SCHEMA)
        tables["cyclable_paris"] = mobility.cycle_density(rows, areas.filter(C.in_city("code")))
    traffic, positions = path("counter_traffic.json"), path("counter_positions.json")
    if traffic and positions:
        tables["comptage_velo_paris"] = mobility.place_counters(
            records.read_records(spark, traffic, schemas.TRAFFIC_SCHEMA),
            records.read_counters(spark, positions), F.col("seq"),
        )
    return tables


def refresh(
    spark: SparkSession,
    folder: str,
    target: str,
    version: int = 1,
    limits: S.Thresholds = S.Thresholds(),
    zone_documents: bool = False,
    today: str | None = None,
    **scope,
) -> DataFrame:
    """Rebuild all result tables from the files in ``folder``.

    Everything goes to ``target/v<version>``: the result tables and their CSV
    copies. Sales are loaded into ``target/sales``, where a version rewrites
    only the years that it touches. An interrupted refresh leaves the previous
    version as it is, so readers move on once the new one is complete. Tables
    stored on the way are deleted at the end. Returns the violation count of
    every data-quality rule.

    The rules run before anything is published: a violated rule, or sales
    or files older than allowed on the day ``today`` if that is given, raises
    ``QualityError``: no result table is written, and the sales version is dropped.
    """
    with temporary_copies(spark):
        return _refresh(spark, folder, target, version, limits, zone_documents, today, scope)


def _refresh(
    spark: SparkSession,
    folder: str,
    target: str,
    version: int,
    limits: S.Thresholds,
    zone_documents: bool,
    today: str | None,
    scope: Mapping[str, Sequence[str]],
) -> DataFrame:
    raw = raw_tables(spark, folder, **scope)
    root, sales = f"{target}/v{version}", f"{target}/sales"
    loaded = incremental.load_version(
        spark, sales, staging.clean_sales(raw["sales"]), "date_mutation", "id_mutation", version
    )
    models = build_models(raw, limits, sales=loaded, tension=True)
    results = {
        name: models[name]
        for name in (
            "accessibility", "zones", "evolution", "tension", "crime_detail", "city_rooms", "diplomas"
        )
    }
    results["sale_stats"] = models["sale_stats"]
    try:
        counts = quality.gate(quality.check_all(models))
        if today is not None:
            ages = quality.check_sources(models, F.lit(today).cast("date"), source_files(spark, folder))
            stale = ages.filter("status = 'error'").collect()  # a row per source
            if stale:
                raise quality.QualityError({f"{r['table_name']}_fresh": 1 for r in stale})
    except quality.QualityError:
        # Its watermark would hide a corrected delivery from the next version.
        incremental.drop_version(spark, sales, version)
        raise
    areas = boundaries(spark, folder)
    if areas is not None:
        areas = materialise(areas)
        results |= mobility_tables(spark, folder, areas)
        results["department_outlines"] = outlines(areas)
        sinks.write_geojson_by_zone(areas, f"{root}/geojson", documents=zone_documents)
        sinks.write_outline_polygons(department_rings(areas), f"{root}/geojson_departments")
    sinks.publish(results, f"{root}/tables")
    stored_tables = {name: spark.read.parquet(f"{root}/tables/{name}") for name in results}
    for name in ("accessibility", "zones", "evolution", "tension"):
        sinks.export_csv(stored_tables[name], f"{root}/csv/{name}")
    return counts
