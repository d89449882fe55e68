"""Points, polygons and boundaries.

A geometry is ``array<array<array<array<double>>>>``: multipolygon, polygon,
ring, [x, y]. Rings are closed (first point = last point).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from territory import settings as S
from territory.functions import clean as C
from territory.operators.storage import materialise

GEOMETRY_TYPE = "array<array<array<array<double>>>>"

#: A cell with more edges and turns than this is split in four.
CELL_EDGES = 32
#: How often a cell may be split: edges that meet in one vertex cannot be parted.
MOST_SPLITS = 20
#: Cells up to this size are sent to every task; beyond it points and cells are shuffled.
BROADCAST_BYTES = 8 << 20
#: A join cell with more than one in so many points is dealt out.
HOT_SHARE = 200


def _ring_edges(ring: Column) -> Column:
    """Edges of a ring, each stated upwards; horizontal ones are left out."""

    def edge(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
        upward = a[1] < b[1]
        low, high = F.when(upward, a).otherwise(b), F.when(upward, b).otherwise(a)
        return F.struct(
            low[0].alias("x1"), low[1].alias("y1"), high[0].alias("x2"), high[1].alias("y2")
        )

    edges = F.transform(F.sequence(F.lit(1), F.size(ring) - 1), edge)
    return F.when(F.size(ring) > 1, F.filter(edges, lambda e: e.y1 < e.y2))


def edges_of(geom: Column) -> Column:
    """All non-horizontal edges of all rings, holes included."""
    return F.flatten(F.transform(F.flatten(geom), _ring_edges))


def _extent(geom: Column, axis: int) -> tuple[Column, Column]:
    values = F.transform(F.flatten(F.flatten(geom)), lambda p: p[axis])
    return F.array_min(values), F.array_max(values)


def _with_odd(frame: DataFrame, values: str) -> DataFrame:
    """The array ``values`` sorted, with only what it holds an odd number of times, each once."""
    frame = frame.withColumn("_all", F.sort_array(values))
    places = F.sequence(F.lit(0), F.size("_all") - 1)
    differs = F.filter(places, lambda i: (i == 0) | (F.get("_all", i) != F.get("_all", i - 1)))
    frame = frame.withColumn("_starts", F.when(F.size("_all") > 0, differs).otherwise(F.array().cast("array<int>")))
    frame = frame.withColumn("_ends", F.slice(F.concat("_starts", F.array(F.size("_all"))), 2, F.size("_all") + 1))
    runs = F.transform("_starts", lambda start, k: F.when((F.get("_ends", k) - start) % 2 == 1, F.get("_all", start)))
    return frame.withColumn(values, F.filter(runs, lambda v: v.isNotNull())).drop("_all", "_starts", "_ends")


def _side_of(e: Column) -> Column:
    """1 if an edge runs to the right of a cell at all heights they share, -1 if to the left, else 0.

    An edge within rounding of the cell counts as 0: it is tested against each point.
    """
    left, right, bottom, top = (F.col(c) for c in ("_left", "_right", "_bottom", "_top"))
    width, height = e.x2 - e.x1, e.y2 - e.y1

    def ahead(x: Column, y: Column) -> Column:
        return width * (y - e.y1) - (x - e.x1) * height

    low, high = F.greatest(e.y1, bottom), F.least(e.y2, top)
    slack = (F.abs(width) + F.abs(right - e.x1) + F.abs(left - e.x1)) * height * 1e-12
    beyond = F.least(ahead(right, low), ahead(right, high)) > slack
    before = F.greatest(ahead(left, low), ahead(left, high)) < -slack
    # Most edges have both ends well beside the cell, which costs less to see.
    far_left, far_right = F.col("_far_left"), F.col("_far_right")
    clear = F.when((e.x1 > far_right) & (e.x2 > far_right), 1).when((e.x1 < far_left) & (e.x2 < far_left), -1)
    return clear.when(beyond, 1).when(before, -1).otherwise(0)


def _clipped(cells: DataFrame) -> DataFrame:
    """Cells with what they need of the ``edges``, ``base`` and ``turns`` of the cell they were cut from.

    ``edges`` are those that cross the cell. Edges wholly to the right of
    it are crossed by every ray that passes their height, so they only count:
    ``base`` is the parity of their number at the cell's lower side, ``turns`` are
    the heights inside the cell at which it changes. Edges that follow each
    other cancel there, so a cell's turns stem from edges that it holds.
    """
    side = F.col("side")
    left, bottom = F.col("cx") * side, F.col("cy") * side
    # Columns of their own: a lambda works its expressions out for every edge.
    cells = cells.withColumns({"_left": left, "_right": left + side, "_bottom": bottom, "_top": bottom + side})
    cells = cells.withColumns({"_far_left": F.col("_left") - side / (1 << 20), "_far_right": F.col("_right") + side / (1 << 20)})
    bottom, top = F.col("_bottom"), F.col("_top")
    cells = cells.withColumn("_band", F.filter("edges", lambda e: (e.y2 > bottom) & (e.y1 < top)))
    cells = cells.withColumn("_beyond", F.filter("_band", lambda e: _side_of(e) > 0))
    below = F.size(F.filter("turns", lambda t: t <= bottom))
    crossed = F.size(F.filter("_beyond", lambda e: (e.y1 <= bottom) & (bottom < e.y2)))
    ends = [F.transform("_beyond", lambda e: e.y1), F.transform("_beyond", lambda e: e.y2)]
    heights = F.filter(F.concat("turns", *ends), lambda t: (t > bottom) & (t < top))
    near = F.filter("_band", lambda e: _side_of(e) == 0)
    cells = cells.withColumns({"base": (F.col("base") + below + crossed) % 2, "edges": near, "turns": heights})
    return _with_odd(cells.drop("_band", "_beyond", "_left", "_right", "_bottom", "_top", "_far_left", "_far_right"), "turns")


def _stored(cells: DataFrame) -> DataFrame:
    """Clipped cells, stored, less those outside.

    The filter comes after the store: Spark would push it below the clipping and so clip
    for it again, several times over.
    """
    touched = (F.size("edges") > 0) | (F.size("turns") > 0) | (F.col("base") == 1)
    return materialise(_clipped(cells)).filter(touched)


def polygon_cells(polygons: DataFrame, keys: Sequence[str], geom: str) -> DataFrame:
    """Polygons cut into square cells: one row per polygon and cell that it touches.

    A cell (``side``, ``cx``, ``cy``; sides are powers of two) spans cx to cx + 1
    sides and cy to cy + 1. A polygon starts with at most 3 x 3 cells; a
    cell that holds more than ``CELL_EDGES`` edges is split in four, again and
    again, so cells are small where a boundary is dense. A cell wholly inside
    has ``base`` 1 and neither edges nor turns; cells outside are left out.
    """
    x_low, x_high = _extent(F.col(geom), 0)
    y_low, y_high = _extent(F.col(geom), 1)
    # Few bytes of polygons are much work: they are dealt to all tasks.
    tasks = int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    boxes = polygons.select(*keys, geom).repartition(tasks).select(
        *keys,
        edges_of(F.col(geom)).alias("edges"),
        x_low.alias("x_low"), x_high.alias("x_high"),
        y_low.alias("y_low"), y_high.alias("y_high"),
    ).filter(F.size("edges") > 0)
    extent = F.greatest(F.col("x_high") - F.col("x_low"), F.col("y_high") - F.col("y_low"))
    furthest = F.greatest(*[F.abs(F.col(c)) for c in ("x_low", "x_high", "y_low", "y_high")])
    # Doubles hold 53 bits: a side much below the coordinates would not be exact.
    finest = F.ceil(F.log2(furthest)) - 50
    level = F.greatest(F.ceil(F.log2(extent)) - 1, finest)
    least = F.greatest(level - MOST_SPLITS, finest)
    boxes = boxes.withColumns({"side": F.pow(F.lit(2.0), level), "least": F.pow(F.lit(2.0), least)})

    def touched(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(low) / F.col("side")), F.floor(F.col(high) / F.col("side"))))

    start = boxes.withColumn("cx", touched("x_low", "x_high")).withColumn("cy", touched("y_low", "y_high"))
    columns = [*keys, "side", "least", "cx", "cy", "edges"]
    start = start.select(*columns, F.lit(0).alias("base"), F.array().cast("array<double>").alias("turns"))
    heavy = (F.size("edges") + F.size("turns") > CELL_EDGES) & (F.col("side") > F.col("least"))
    state, done = _stored(start), []
    while not state.filter(heavy).isEmpty():
        done.append(state.filter(~heavy))
        half = F.array(F.lit(0), F.lit(1))
        quarters = state.filter(heavy).withColumn("dx", F.explode(half)).withColumn("dy", F.explode(half)).select(
            *keys, (F.col("side") / 2).alias("side"), "least", (F.col("cx") * 2 + F.col("dx")).alias("cx"),
            (F.col("cy") * 2 + F.col("dy")).alias("cy"), "edges", "base", "turns",
        )
        state = _stored(quarters)
    return reduce(DataFrame.unionByName, [*done, state]).drop("least")


def join_side(sides: dict[float, int]) -> float:
    """Side of the cells that points and polygons meet in, from the number of cells of each side.

    The finest one for which larger cells, stated once per join cell, come to
    at most four times the cells there are (and some thousands).
    """
    total = sum(sides.values())
    for chosen in sorted(sides):
        if sum(n * max(1.0, side / chosen) ** 2 for side, n in sides.items()) <= 4 * total + 10_000:
            return chosen
    return max(sides)


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    x: str,
    y: str,
    keys: Sequence[str],
    geom: str = "geom",
) -> DataFrame:
    """Inner join of points with the polygons that contain them.

    Every point has one join cell, whatever the sizes of the polygons; it meets
    the polygon cells there in one equi-join, drops those it does not lie in and
    takes an even-odd ray test on the few edges of the others. Edges are
    half-open and stated in one direction, so a point on a border that two
    polygons share falls in exactly one of them. The output has the columns of
    ``points`` and ``keys``.

    Cells of at most ``BROADCAST_BYTES`` go to every task. More of them are
    shuffled: points are counted per join cell, and a cell with a large share
    of them is dealt to several tasks, its polygon cells copied to each.
    """
    renamed = {k: f"_key_{n}" for n, k in enumerate(keys)}
    named = polygons.select(*[F.col(k).alias(v) for k, v in renamed.items()], F.col(geom).alias("geom"))
    cells = polygon_cells(named, list(renamed.values()), "geom")
    side = F.col("side")
    # A row per side: powers of two, so at most some 2000.
    sizes = cells.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.sum(100 + 32 * F.size("edges") + 8 * F.size("turns")).alias("bytes"),
        F.min(F.col("cx") * side).alias("x_low"), F.max((F.col("cx") + 1) * side).alias("x_high"),
        F.min(F.col("cy") * side).alias("y_low"), F.max((F.col("cy") + 1) * side).alias("y_high"),
    ).collect()
    if not sizes:
        absent = [F.lit(None).cast(polygons.schema[k].dataType).alias(k) for k in keys]
        return points.filter(F.lit(False)).select("*", *absent)
    meeting = join_side({r["side"]: r["n"] for r in sizes})
    copies = sum(r["bytes"] * max(1.0, r["side"] / meeting) ** 2 for r in sizes)

    def spread(c: str) -> Column:
        first = F.floor(F.col(c) * side / meeting)
        return F.explode(F.sequence(first, first + F.greatest(side / meeting, F.lit(1.0)).cast("long") - 1))

    cells = cells.withColumn("_jx", spread("cx")).withColumn("_jy", spread("cy"))
    cells = cells.withColumnsRenamed({c: f"_{c}" for c in ("side", "cx", "cy", "edges", "base", "turns")})
    px, py = F.col(x), F.col(y)
    low = [min(r[c] for r in sizes) for c in ("x_low", "y_low")]
    high = [max(r[c] for r in sizes) for c in ("x_high", "y_high")]
    within = (px >= low[0]) & (px < high[0]) & (py >= low[1]) & (py < high[1])
    located = points.filter(within).withColumns({"_jx": F.floor(px / meeting), "_jy": F.floor(py / meeting)})
    on = ["_jx", "_jy"]
    if copies <= BROADCAST_BYTES:
        cells = F.broadcast(cells)
    else:
        located, cells = _dealt(located, cells, on)
        on = [*on, "_salt"]

    def crossed(e: Column) -> Column:
        in_band = (e.y1 <= py) & (py < e.y2)
        to_the_left = (px - e.x1) * (e.y2 - e.y1) < (e.x2 - e.x1) * (py - e.y1)
        return in_band & to_the_left

    in_cell = (F.floor(px / F.col("_side")) == F.col("_cx")) & (F.floor(py / F.col("_side")) == F.col("_cy"))
    count = F.col("_base") + F.size(F.filter("_turns", lambda t: t <= py)) + F.size(F.filter("_edges", crossed))
    met = located.join(cells, on).filter(in_cell).filter(count % 2 == 1)
    return met.select(*[F.col(f"`{c}`") for c in points.columns], *[F.col(v).alias(k) for k, v in renamed.items()])


def _dealt(located: DataFrame, cells: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: points of a hot join cell are dealt out, its polygon cells copied as often."""
    counts = materialise(located.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    share = max(1, -(-total // HOT_SHARE))
    # Fewer than HOT_SHARE rows: each stands for more than a share of the points.
    hot = F.broadcast(counts.filter(F.col("_n") > share).select(*on, F.ceil(F.col("_n") / share).alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = located.join(hot, on, "left").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), salts))
    copied = cells.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    return dealt.drop("_salts"), copied.drop("_salts")


def _ring_area(ring: Column) -> Column:
    """Planar area by the shoelace formula, relative to the first point."""

    def term(i: Column) -> Column:
        a, b, o = F.element_at(ring, i), F.element_at(ring, i + 1), F.element_at(ring, 1)
        return (a[0] - o[0]) * (b[1] - o[1]) - (b[0] - o[0]) * (a[1] - o[1])

    terms = F.transform(F.sequence(F.lit(1), F.size(ring) - 1), term)
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)) / 2


def planar_area(geom: Column) -> Column:
    """Outer rings less holes, in squared coordinate units."""

    def polygon(rings: Column) -> Column:
        areas = F.transform(rings, _ring_area)
        holes = F.aggregate(F.slice(areas, 2, F.size(areas)), F.lit(0.0), lambda a, v: a + v)
        return F.element_at(areas, 1) - holes

    return F.aggregate(F.transform(geom, polygon), F.lit(0.0), lambda acc, v: acc + v)


def polygon_area_km2(geom: Column) -> Column:
    return planar_area(geom) * S.KM_PER_DEGREE * S.KM_PER_DEGREE * S.LATITUDE_FACTOR


def with_area(polygons: DataFrame, keys: Sequence[str], geom: str = "geom") -> DataFrame:
    return polygons.select(*keys, polygon_area_km2(F.col(geom)).alias("area_km2"))


def round_coordinates(geom: Column, digits: int = 4) -> Column:
    def point(p: Column) -> Column:
        return F.transform(p, lambda v: F.round(v, digits))

    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(ring, point)))


def merge_features(communes: DataFrame, districts: DataFrame, digits: int = 4) -> DataFrame:
    """Communes without the city as a whole, plus its districts; code, name
    and rounded geometry only."""
    columns = ["code", "nom", round_coordinates(F.col("geom"), digits).alias("geom")]
    kept = communes.filter(F.col("code") != S.CITY_CODE)
    return kept.select(*columns).unionByName(districts.select(*columns))


def dissolve_boundary(
    polygons: DataFrame, key: str, geom: str = "geom", digits: int = 4
) -> DataFrame:
    """Outline of each key's polygons as boundary segments.

    An edge shared by two polygons of a key occurs twice and cancels; what
    occurs once is the outline. Neighbours must share their vertices.
    """
    rings = polygons.select(
        key, F.explode(F.flatten(round_coordinates(F.col(geom), digits))).alias("ring")
    )

    def segment(i: Column) -> Column:
        a = F.element_at(F.col("ring"), i)
        b = F.element_at(F.col("ring"), i + 1)
        return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))

    segments = rings.filter(F.size("ring") > 1).select(
        key, F.explode(F.transform(F.sequence(F.lit(1), F.size("ring") - 1), segment)).alias("s")
    )
    return (
        segments.filter("s.a != s.b")
        .groupBy(key, "s")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n = 1")
        .select(
            key,
            F.col("s.a")[0].alias("x1"), F.col("s.a")[1].alias("y1"),
            F.col("s.b")[0].alias("x2"), F.col("s.b")[1].alias("y2"),
        )
    )


def density(counts: DataFrame, areas: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Amount per square kilometre next to the area, both rounded."""
    joined = counts.join(areas, key)
    return joined.select(
        *counts.columns,
        F.round("area_km2", 2).alias("superficie_km2"),
        F.round(C.safe_divide(amount, "area_km2"), 1).alias(name),
    )
