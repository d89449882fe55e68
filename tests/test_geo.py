import math
import random

import pytest
from pyspark.sql import functions as F

from territory.operators import geo as G

SQUARE = [[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]


def square(x, y, side=1.0):
    x, y = float(x), float(y)
    return [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]


@pytest.fixture
def polygons(spark):
    def make(**shapes):
        return spark.createDataFrame(list(shapes.items()), f"code string, geom {G.GEOMETRY_TYPE}")

    return make


@pytest.fixture
def points(spark):
    def make(*xy):
        return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id int, x double, y double")

    return make


def inside(points, polygons):
    return sorted((r["id"], r["code"]) for r in G.points_in_polygons(points, polygons, "x", "y", ["code"]).collect())


def brute(x, y, geom):
    odd = False
    for ring in (ring for poly in geom for ring in poly):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def star(cx, cy, r, rng):
    corners = rng.randint(3, 40)
    ring = []
    for i in range(corners):
        a, d = 2 * math.pi * i / corners, r * rng.uniform(0.3, 1)
        ring.append([cx + d * math.cos(a), cy + d * math.sin(a)])
    return ring + [ring[0]]


def test_point_in_square(points, polygons):
    assert inside(points((1, 1), (3, 1)), polygons(s=[[SQUARE]])) == [(0, "s")]


def test_hole_and_parts(points, polygons):
    geom = [[square(0, 0, 10), square(4, 4, 2)], [square(20, 0, 1)]]
    assert inside(points((5, 5), (1, 1), (20.5, 0.5), (15, 0.5)), polygons(m=geom)) == [(1, "m"), (2, "m")]


def test_matches_brute_force_on_mixed_sizes(points, polygons):
    rng = random.Random(3)
    shapes = {}
    for i in range(40):
        r = 10 ** rng.uniform(-3, 2)
        cx, cy = rng.uniform(-50, 50), rng.uniform(-50, 50)
        shapes[f"p{i}"] = [[star(cx, cy, r, rng)]]
    shapes["tiny"] = [[square(0.25, 0.25, 1e-6)]]
    xy = [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(400)]
    # A third of the points share one place.
    xy += [(1.234, -2.5)] * 200 + [(0.25 + 5e-7, 0.25 + 5e-7)]
    expected = sorted(
        (i, code) for i, (x, y) in enumerate(xy) for code, geom in shapes.items() if brute(x, y, geom)
    )
    assert expected and inside(points(*xy), polygons(**shapes)) == expected


def test_shared_border_has_one_owner(points, polygons):
    grid = {f"g{x}{y}": [[square(float(x), float(y))]] for x in range(3) for y in range(3)}
    xy = [(1.0, 0.5), (1.0, 1.0), (0.5, 2.0), (2.0, 2.0), (1.5, 1.0)]
    owners = inside(points(*xy), polygons(**grid))
    assert [i for i, _ in owners] == [0, 1, 2, 3, 4]


def test_points_without_position_are_dropped(spark, polygons):
    df = spark.createDataFrame([(1, None, 1.0), (2, 1.0, None)], "id int, x double, y double")
    assert inside(df, polygons(s=[[SQUARE]])) == []


def test_no_cross_join_in_containment(points, polygons):
    from conftest import plan_of

    plan = plan_of(G.points_in_polygons(points((1, 1)), polygons(s=[[SQUARE]]), "x", "y", ["code"]))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def comb(teeth, width=1.0, depth=0.0):
    """A polygon of many edges: teeth of unequal height over a block, horizontal edges included."""
    ring = [[0.0, -depth]]
    for i in range(teeth):
        h = 1.0 + (i * 37 % 11) / 4
        ring += [[i * width, h], [(i + 0.5) * width, h], [(i + 0.5) * width, 0.5]]
    return [*ring, [teeth * width, -depth], [0.0, -depth]]


@pytest.mark.parametrize("dealt", [False, True])
def test_small_cells_give_the_same_answers(points, polygons, monkeypatch, dealt):
    """Cells of few edges, points on vertices and edges, nested and overlapping shapes of all sizes."""
    monkeypatch.setattr(G, "CELL_EDGES", 3)
    monkeypatch.setattr(G, "MOST_SPLITS", 7)
    if dealt:
        monkeypatch.setattr(G, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(G, "HOT_SHARE", 5)
    rng = random.Random(11)
    shapes = {f"s{i}": [[star(rng.uniform(-9, 9), rng.uniform(-9, 9), 10 ** rng.uniform(-2, 1), rng)]] for i in range(12)}
    shapes["comb"] = [[comb(40, 0.25)]]
    shapes["lattice"] = [[square(-4, -4, 8), square(-2, -2, 2)], [square(5, 5, 0.5)]]
    shapes["fan"] = [[[[0.0, 0.0], *[p for k in range(12) for p in ([3.0, k / 4], [3.0, k / 4 + 0.125], [0.0, 0.0])]]]]
    xy = [(rng.uniform(-10, 10), rng.uniform(-10, 10)) for _ in range(300)]
    xy += [(rng.randint(-80, 80) / 8, rng.randint(-40, 40) / 8) for _ in range(600)] + [(1.0, 0.25)] * 300
    expected = sorted((i, code) for i, (x, y) in enumerate(xy) for code, geom in shapes.items() if brute(x, y, geom))
    assert inside(points(*xy), polygons(**shapes)) == expected
    if not dealt:
        cells = G.polygon_cells(polygons(block=[[comb(40, 0.25, 8.0)]]), ["code"], "geom")
        whole = cells.filter("size(edges) = 0 and size(turns) = 0")
        assert whole.count() > 0 and whole.filter("base = 0").count() == 0


def test_a_polygon_of_many_edges_gives_bounded_cells(spark, polygons):
    geom = [[comb(10_000, depth=5000.0)]]
    cells = G.polygon_cells(polygons(big=geom), ["code"], "geom")
    weight = F.size("edges") + F.size("turns")
    assert cells.select(F.max(weight)).first()[0] <= G.CELL_EDGES
    assert cells.select(F.sum(F.size("edges"))).first()[0] < 4 * 30_000
    xy = [(i + 0.125, 0.25 + (i % 13) / 4) for i in range(0, 10_000, 20)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(xy)], "id int, x double, y double")
    expected = [(i, "big") for i, (x, y) in enumerate(xy) if y < 1.0 + (int(x) * 37 % 11) / 4]
    assert inside(df, polygons(big=geom)) == expected


def test_points_are_not_multiplied_and_hot_cells_are_dealt(spark, polygons, monkeypatch):
    from conftest import plan_of

    monkeypatch.setattr(G, "BROADCAST_BYTES", 0)
    shapes = {f"p{i}": [[square(i % 30, i // 30, 10.0 ** (i % 4 - 3))]] for i in range(300)}
    at = F.when(F.col("id") % 10 < 9, 1.05).otherwise(F.col("id") % 30 + 0.0005)
    df = spark.range(20_000).select("id", at.alias("x"), F.lit(0.0005).alias("y")).repartition(8)
    found = G.points_in_polygons(df, polygons(**shapes), "x", "y", ["code"])
    points_side = plan_of(found).split("SortMergeJoin")[-1].split("Generate")[0]
    assert "monotonically_increasing_id" in points_side
    seen = []
    monkeypatch.setattr(G, "_dealt", lambda a, b, on, f=G._dealt: seen.append(f(a, b, on)) or seen[-1])
    G.points_in_polygons(df, polygons(**shapes), "x", "y", ["code"])
    located = seen[0][0]
    assert located.count() == 20_000
    most = located.groupBy("_jx", "_jy", "_salt").count().agg(F.max("count")).first()[0]
    assert most <= 2 * 20_000 / G.HOT_SHARE


def test_join_side_bounds_the_copies():
    assert G.join_side({1.0: 10}) == 1.0
    sides = {2.0**-20: 10_000_000, 2.0**5: 100}
    chosen = G.join_side(sides)
    assert sum(n * max(1.0, s / chosen) ** 2 for s, n in sides.items()) <= 4 * sum(sides.values()) + 10_000


def test_area(polygons):
    geom = [[square(0, 0, 10), square(4, 4, 2)], [square(20, 0, 1)]]
    df = polygons(m=geom)
    assert df.select(G.planar_area(F.col("geom"))).first()[0] == 97.0
    km2 = df.select(G.polygon_area_km2(F.col("geom"))).first()[0]
    assert km2 == pytest.approx(97 * 111.12**2 * 0.6583)


def test_round_and_merge(polygons):
    communes = polygons(**{"75056": [[SQUARE]], "92001": [[square(0.123456, 0)]]}).withColumn("nom", F.col("code"))
    districts = polygons(**{"75101": [[SQUARE]]}).withColumn("nom", F.lit("1er"))
    merged = {r["code"]: r for r in G.merge_features(communes, districts).collect()}
    assert set(merged) == {"92001", "75101"}
    assert merged["92001"]["geom"][0][0][0][0] == 0.1235


def test_dissolve(spark):
    data = [("k", [[square(0.0, 0.0)]]), ("k", [[square(1.0, 0.0)]]), ("j", [[square(1.0, 0.0)]])]
    df = spark.createDataFrame(data, f"key string, geom {G.GEOMETRY_TYPE}")
    got = G.dissolve_boundary(df, "key").collect()
    assert sum(r["key"] == "k" for r in got) == 6
    assert sum(r["key"] == "j" for r in got) == 4
    assert not any(r["key"] == "k" and r["x1"] == r["x2"] == 1.0 for r in got)


def test_cells_are_clipped_once_and_by_all_tasks(spark, monkeypatch):
    stored = []
    real = G.materialise
    monkeypatch.setattr(G, "materialise", lambda df: stored.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df))
    ring = [[0.0, 0.0], [8.0, 0.0], [8.0, 8.0], [0.0, 8.0], [0.0, 0.0]]
    polygons = spark.createDataFrame([("a", [[ring]])], f"code string, geom {G.GEOMETRY_TYPE}").coalesce(1)
    cells = G.polygon_cells(polygons, ["code"], "geom")
    assert cells.filter("base = 1 or size(edges) > 0 or size(turns) > 0").count() == cells.count() > 0
    # No filter works the turns or sides of edges out a second time.
    assert all("CASE WHEN" not in line for plan in stored for line in plan.splitlines() if "Filter" in line[:20] and "_far_left" in line)
    assert all(len(line) < 4000 for plan in stored for line in plan.splitlines() if line.strip(" :+-").startswith("Filter"))
    assert "Repartition" in stored[0]
