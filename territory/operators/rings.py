"""Outlines of groups of polygons: dissolved, closed rings with their holes.

Coordinates become integers of the wanted digits, so every comparison is exact.
Borders that two polygons of a group share cancel, also where their vertices
differ; the directed edges left are linked at their vertices and put in order by
pointer doubling, so a ring of n edges takes about log2(n) joins and no task
walks along it. Only the finished ring is one value, as a geometry is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from territory.operators import geo
from territory.operators.storage import materialise

#: A ring has fewer than 2 to this power edges.
MOST_ROUNDS = 40


def _twice_area(ring: Column) -> Column:
    """Twice the signed area of an integer ring: positive if it runs counterclockwise."""

    def term(i: Column) -> Column:
        a, b, o = F.get(ring, i), F.get(ring, i + 1), F.get(ring, F.lit(0))
        return (a.x - o.x) * (b.y - o.y) - (b.x - o.x) * (a.y - o.y)

    places = F.sequence(F.lit(0), F.size(ring) - 2)
    return F.aggregate(places, F.lit(0).cast("long"), lambda total, i: total + term(i))


def directed_edges(polygons: DataFrame, key: str, geom: str, digits: int) -> DataFrame:
    """Edges of all rings on the integer grid, each with its polygon on the left: ``_key``, ``a``, ``b``."""
    scale = 10.0**digits

    def grid(p: Column) -> Column:
        return F.struct(F.round(p[0] * scale).cast("long").alias("x"), F.round(p[1] * scale).cast("long").alias("y"))

    # Few bytes of polygons are much work: they are dealt to all tasks.
    tasks = int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = polygons.select(F.col(key).alias("_key"), F.col(geom).alias("geom")).repartition(tasks)
    rings = dealt.select("_key", F.explode("geom").alias("rings")).select("_key", F.posexplode("rings").alias("place", "ring"))
    rings = rings.filter(F.size("ring") > 3).select("_key", "place", F.transform("ring", grid).alias("ring"))
    rings = rings.withColumn("area", _twice_area(F.col("ring")))
    turned = (F.col("area") > 0) != (F.col("place") == 0)
    places = F.sequence(F.lit(0), F.size("ring") - 2)
    forth = F.transform(places, lambda i: F.struct(F.get("ring", i).alias("a"), F.get("ring", i + 1).alias("b")))
    back = F.transform(places, lambda i: F.struct(F.get("ring", i + 1).alias("a"), F.get("ring", i).alias("b")))
    # Flat rings have no edges here. A filter on the area, or one that an inner inline brings with it,
    # would be pushed below all this and work it out again.
    edges = F.when(F.col("area") != 0, F.when(turned, back).otherwise(forth))
    return rings.select("_key", F.inline_outer(edges)).filter("a != b")


def outline_edges(edges: DataFrame) -> DataFrame:
    """Edges that border nothing of their group on the right: ``_key``, ``a``, ``b``, stored with an ``id``.

    Equal edges of two neighbours cancel in one grouped sum. What is left is
    compared along its line: the edges of a line add up to a running cover of
    it, and the stretches with a cover are the outline. Edges that differ only
    in where they are divided, as at a vertex inside a neighbour's edge, so
    cancel too. A line holds what did not cancel before.
    """
    forward = F.col("a") < F.col("b")
    sums = edges.groupBy("_key", F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).agg(
        F.sum(F.when(forward, 1).otherwise(-1)).alias("cover")
    )
    dx, dy = F.col("high.x") - F.col("low.x"), F.col("high.y") - F.col("low.y")
    flat = F.abs(dx) >= F.abs(dy)
    # Quotients of integers below 2^26 are equal as doubles only if they are equal.
    slope = F.when(flat, dy / dx).otherwise(dx / dy)
    cross = dx * F.col("low.y") - dy * F.col("low.x")
    lined = sums.filter("cover != 0").select(
        "_key", "low", "high", "cover", F.struct(flat, slope, F.when(flat, cross / dx).otherwise(cross / dy)).alias("line")
    )
    ends = F.array(
        F.struct(F.col("low").alias("at"), F.col("cover").alias("change")),
        F.struct(F.col("high").alias("at"), (-F.col("cover")).alias("change")),
    )
    stops = lined.select("_key", "line", F.inline(ends)).groupBy("_key", "line", "at").agg(F.sum("change").alias("change"))
    # Points of a line ascend with it, whichever way it runs.
    along = Window.partitionBy("_key", "line").orderBy("at")
    covered = stops.select(
        "_key", "at", F.lead("at").over(along).alias("next"),
        F.sum("change").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("cover"),
    ).filter("cover != 0")
    right_way = F.col("cover") > 0
    found = covered.select(
        "_key",
        F.when(right_way, F.col("at")).otherwise(F.col("next")).alias("a"),
        F.when(right_way, F.col("next")).otherwise(F.col("at")).alias("b"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.abs("cover"))).alias("copy"),
    )
    return materialise(found.select(F.monotonically_increasing_id().alias("id"), "_key", "a", "b"))


def _followers(edges: DataFrame) -> DataFrame:
    """``id`` and ``follower``: the edge that goes on from an edge's end.

    Where several edges leave a vertex, those that arrive and those that leave
    alternate around it; each arriving one goes on with the next that leaves,
    clockwise, which borders the same inside.
    """
    def angle(to: str, of: str) -> Column:
        return F.atan2((F.col(f"{to}.y") - F.col(f"{of}.y")).cast("double"), (F.col(f"{to}.x") - F.col(f"{of}.x")).cast("double"))

    arriving = F.struct(F.col("b").alias("at"), F.lit(True).alias("arrives"), angle("a", "b").alias("angle"))
    leaving = F.struct(F.col("a").alias("at"), F.lit(False).alias("arrives"), angle("b", "a").alias("angle"))
    halves = edges.select("_key", "id", F.inline(F.array(arriving, leaving)))
    spoke = F.struct("angle", "id")
    corners = halves.groupBy("_key", "at").agg(
        F.array_sort(F.collect_list(F.when(F.col("arrives"), spoke))).alias("arriving"),
        F.array_sort(F.collect_list(F.when(~F.col("arrives"), spoke))).alias("leaving"),
    )
    count = F.size("arriving")
    before = F.when(F.get("leaving", F.lit(0)).angle < F.get("arriving", F.lit(0)).angle, 0).otherwise(count - 1)
    pairs = F.transform(
        "arriving", lambda spoke, i: F.struct(spoke.id.alias("id"), F.get("leaving", (i + before) % count).id.alias("follower"))
    )
    return corners.select(F.inline(pairs))


def ordered_edges(edges: DataFrame) -> DataFrame:
    """Edges with ``ring`` (id of the first edge of their ring) and ``ahead`` (edges from here to that one).

    Every round doubles the stretch of a ring that an edge knows the smallest
    edge of. All is known once no edge differs from the one its stretch ends at.
    """
    first = F.struct("a", "b", "id")
    state = edges.join(_followers(edges), "id").select(
        "id", "_key", F.col("a"), F.col("follower").alias("jump"), first.alias("least"), F.lit(0).cast("long").alias("ahead")
    )
    state = materialise(state)
    for n in range(MOST_ROUNDS):
        there = state.select(F.col("id").alias("jump"), F.col("jump").alias("_jump"), F.col("least").alias("_least"), F.col("ahead").alias("_ahead"))
        mine, theirs = F.struct("least", "ahead"), F.struct(F.col("_least").alias("least"), (F.col("_ahead") + (1 << n)).alias("ahead"))
        met = state.join(there, "jump").select(
            "id", "_key", "a", F.col("_jump").alias("jump"), F.least(mine, theirs).alias("known"),
            (F.col("least") != F.col("_least")).alias("differs"),
        )
        met = materialise(met.select("id", "_key", "a", "jump", "known.*", "differs"))
        if met.filter("differs").isEmpty():
            break
        state = met.drop("differs")
    return state.select("_key", "a", F.col("least.id").alias("ring"), "ahead")


def outline_rings(polygons: DataFrame, key: str, geom: str = "geom", digits: int = 4) -> DataFrame:
    """Closed rings of each group's outline on the integer grid: ``_key``, ``ring``, ``points``, ``area`` (twice, signed).

    Outer rings run counterclockwise and have a positive area, holes the other way round.
    """
    edges = ordered_edges(outline_edges(directed_edges(polygons, key, geom, digits)))
    # The first edge has none ahead; the one after it has the most.
    place = F.when(F.col("ahead") == 0, F.lit(-(1 << 62))).otherwise(-F.col("ahead"))
    rings = edges.groupBy("_key", "ring").agg(F.array_sort(F.collect_list(F.struct(place.alias("place"), "a"))).alias("points"))
    points = F.transform("points", lambda p: p.a)
    rings = rings.withColumn("points", F.concat(points, F.slice(points, 1, 1)))
    return rings.withColumn("area", _twice_area(F.col("points")))


def outlines(polygons: DataFrame, key: str, geom: str = "geom", digits: int = 4) -> DataFrame:
    """One multipolygon per key: the union of its polygons, with holes. Columns: ``key`` and ``geom``.

    Polygons of a key may touch but not overlap; where they do, what is
    covered twice is stated twice. Parts that touch in a point only are polygons of
    their own. Gaps between neighbours stay as holes: coordinates are rounded
    to ``digits``, not widened. Coordinates must stay below 2^25 of these
    units. A null key is a group; null or flat geometries count for nothing.
    """
    rings = materialise(outline_rings(polygons.filter(F.col(geom).isNotNull()), key, geom, digits))
    scale = float(10**digits)
    loops = F.transform("points", lambda p: F.array(p.x / scale, p.y / scale))
    outer, holes = rings.filter("area > 0"), rings.filter("area < 0")
    # The middle of a hole's edge lies inside the ring around it, on no border of it.
    a, b = F.get("points", F.lit(0)), F.get("points", F.lit(1))
    marks = holes.select(
        F.col("ring").alias("hole"), F.col("_key").alias("hole_key"), ((a.x + b.x) / 2).alias("x"), ((a.y + b.y) / 2).alias("y"),
        loops.alias("loop"),
    )
    shape = F.array(F.array(F.transform("points", lambda p: F.array(p.x.cast("double"), p.y.cast("double")))))
    shapes = outer.select("_key", "ring", "area", shape.alias("geom"))
    around = geo.points_in_polygons(marks, shapes, "x", "y", ["_key", "ring", "area"]).filter(F.col("_key").eqNullSafe(F.col("hole_key")))
    owned = around.groupBy("hole").agg(F.min_by(F.struct("ring", "loop"), "area").alias("in"))
    inner = owned.groupBy(F.col("in.ring").alias("ring")).agg(F.array_sort(F.collect_list("in.loop")).alias("inner"))
    parts = outer.select("_key", "ring", loops.alias("loop")).join(inner, "ring", "left")
    whole = F.concat(F.array("loop"), F.coalesce("inner", F.array().cast("array<array<array<double>>>")))
    return parts.groupBy("_key").agg(F.array_sort(F.collect_list(whole)).alias("geom")).select(F.col("_key").alias(key), "geom")


def open_rings(polygons: DataFrame, geom: str = "geom") -> DataFrame:
    """Polygons with a ring that does not end where it starts, or has fewer than three corners."""
    closed = F.forall(F.flatten(geom), lambda r: (F.size(r) > 3) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)))
    return polygons.filter(~closed)
