"""JSON sources: record lists and feature collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from territory import schemas
from territory.operators.geo import GEOMETRY_TYPE


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    root: str = "results",
    position: str | None = None,
) -> DataFrame:
    """Rows of the array found at the dotted ``root`` of each document, with
    their place (file, then place in it) as ``position`` if asked for."""
    nested: T.DataType = T.ArrayType(schema)
    for name in reversed(root.split(".")):
        nested = T.StructType([T.StructField(name, nested)])
    documents = spark.read.schema(nested).json(path, multiLine=True)
    if position is None:
        return documents.select(F.inline(root))
    # Pages of one listing are files of a folder: the file comes first, then the place in it.
    place = F.struct(F.col("page"), F.col("place")).alias(position)
    paged = documents.select(F.col("_metadata.file_path").alias("page"), F.col(root).alias("records"))
    return paged.select("page", F.posexplode("records").alias("place", "record")).select(place, "record.*")


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Bike stations; the older numeric id stands in for a missing code."""
    rows = read_records(spark, path, schemas.STATION_SCHEMA, "data.stations")
    code = F.coalesce("stationCode", "station_id").alias("code")
    return rows.select(code, "name", "lat", "lon", "capacity")


def read_stops(spark: SparkSession, paths_in_order: list[str]) -> DataFrame:
    """Transit stops with their position: files in the stated order, then
    records in file order."""
    frames = []
    for i, path in enumerate(paths_in_order):
        rows = read_records(spark, path, schemas.STOP_SCHEMA, position="pos")
        frames.append(
            rows.select(
                F.struct(F.lit(i).alias("source"), "pos").alias("seq"),
                "stop_name", F.col("stop_lat").cast("double").alias("lat"),
                F.col("stop_lon").cast("double").alias("lon"),
                "mode", F.col("shortname").alias("line"),
            )
        )
    stops = frames[0]
    for frame in frames[1:]:
        stops = stops.unionByName(frame)
    return stops


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """Counter positions in file order."""
    rows = read_records(spark, path, schemas.COUNTER_SCHEMA, position="seq")
    return rows.select("seq", "id_compteur", "coordinates.lat", "coordinates.lon")


def geometry(kind: Column, coordinates: Column) -> Column:
    """Geometry from its GeoJSON type and coordinate text; a polygon becomes a
    multipolygon of one, other kinds become null."""
    polygon = F.array(F.from_json(coordinates, "array<array<array<double>>>"))
    many = F.from_json(coordinates, GEOMETRY_TYPE)
    return F.when(kind == "Polygon", polygon).when(kind == "MultiPolygon", many)


_FEATURE = T.StructType(
    [
        T.StructField(
            "properties",
            T.StructType([T.StructField("code", T.StringType()), T.StructField("nom", T.StringType())]),
        ),
        T.StructField(
            "geometry",
            T.StructType(
                [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
            ),
        ),
    ]
)


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Features as (code, nom, geom).

    A feature collection is one document in a file of its own, read by one
    task; the files of a folder are its parts. Large boundary sets come as one
    feature per line (``lines``), which Spark splits.
    """
    if lines:
        features = spark.read.schema(_FEATURE).json(path)
    else:
        collection = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])
        # Parsed from the text: to cut coordinates out of a file, the JSON reader opens it again for each feature.
        documents = spark.read.text(path, wholetext=True).select(F.ltrim("value", F.lit("\ufeff")).alias("value"))
        features = documents.select(F.from_json("value", collection).alias("d")).select(F.inline("d.features"))
    return features.select(
        "properties.code",
        "properties.nom",
        geometry(F.col("geometry.type"), F.col("geometry.coordinates")).alias("geom"),
    )
