"""Bike, cycle-path and transit indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from territory.functions import clean as C
from territory.operators import geo as G
from territory.operators.aggregate import distinct_by, sum_by, sum_in_period
from territory.operators.dedup import distinct_values, first_values
from territory.operators.joins import lookup_last, top_k

_AREA_KEYS = {"code": "code_commune", "nom": "nom_commune"}


def tag_points(points: DataFrame, areas: DataFrame) -> DataFrame:
    """Points with the code and name of the commune around them."""
    named = areas.withColumnsRenamed(_AREA_KEYS)
    return G.points_in_polygons(points, named, "lon", "lat", list(_AREA_KEYS.values()))


def commune_areas(areas: DataFrame) -> DataFrame:
    return G.with_area(areas, ["code"]).withColumnRenamed("code", "code_commune")


def bike_density(stations: DataFrame, areas: DataFrame) -> DataFrame:
    """Bike stations and capacity per commune and square kilometre; communes
    without a station are absent."""
    counts = tag_points(stations, areas).groupBy("code_commune", "nom_commune").agg(
        F.count(F.lit(1)).cast("int").alias("nb_stations"),
        F.sum("capacity").cast("int").alias("capacite_totale"),
    )
    return G.density(counts, commune_areas(areas), "code_commune", "nb_stations", "stations_par_km2")


def station_lines(stops: DataFrame) -> DataFrame:
    """One row per physical station and line; a station sits at its first
    record's position. ``stops``: seq, stop_name, lat, lon, line."""
    positions = first_values(stops, "stop_name", ["lat", "lon"], F.col("seq"))
    return positions.join(distinct_values(stops, "stop_name", "line"), "stop_name").select(
        F.col("stop_name").alias("name"), "lat", "lon", "line"
    )


def transit_density(stops: DataFrame, areas: DataFrame) -> DataFrame:
    """Distinct stations and lines per commune, stations per square kilometre."""
    served = tag_points(station_lines(stops), areas).select(
        "name", "line", "code_commune", "nom_commune"
    )
    counts = distinct_by(
        served.dropDuplicates(), ["code_commune", "nom_commune"],
        {"nb_stations": "name", "nb_lignes_uniques": "line"},
    ).withColumns(
        {c: F.col(c).cast("int") for c in ("nb_stations", "nb_lignes_uniques")}
    )
    return G.density(counts, commune_areas(areas), "code_commune", "nb_stations", "stations_par_km2")


def cycle_density(paths: DataFrame, areas: DataFrame) -> DataFrame:
    """Cycle-path kilometres per city district and square kilometre."""
    lengths = sum_by(paths, ["arrondissement"], "longueur_m", "longueur_m").select(
        C.district_code("arrondissement").alias("code"),
        F.col("arrondissement").cast("int").alias("arrondissement"),
        F.round(F.col("longueur_m") / 1000, 1).alias("longueur_km"),
    )
    joined = lengths.join(G.with_area(areas, ["code", "nom"]), "code")
    return joined.select(
        F.col("code").alias("code_commune"), F.col("nom").alias("nom_commune"),
        "arrondissement", "longueur_km",
        F.round(C.safe_divide("longueur_km", "area_km2"), 1).alias("km_par_km2"),
    ).orderBy("arrondissement")


def place_counters(traffic: DataFrame, positions: DataFrame, order: Column) -> DataFrame:
    """Counters with the position of their last record, busiest first;
    counters without a position are dropped."""
    placed = lookup_last(traffic, positions, "id_compteur", order, "lat")
    return placed.select(
        F.col("nom_compteur").alias("nom"), "lat", "lon", "total_passages"
    ).orderBy(F.desc("total_passages"), "nom")


def located_counters(
    counts: DataFrame, positions: DataFrame, order: Column, start: str, end: str, k: int = 30
) -> DataFrame:
    """Busiest ``k`` counters of a period [start, end), with their position;
    the cut comes first, unplaced counters are dropped after it."""
    traffic = sum_in_period(
        counts, ["id_compteur", "nom_compteur"], "day", start, end, "passages", "total_passages"
    ).withColumn("total_passages", F.col("total_passages").cast("bigint"))
    busiest = top_k(traffic, "total_passages", k, ["id_compteur", "nom_compteur"])
    return place_counters(busiest, positions, order)
