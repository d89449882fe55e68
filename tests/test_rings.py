"""Dissolved outlines: rings close, areas add up, holes find their ring."""

import random

import pytest
from pyspark.sql import functions as F

from territory.operators import geo as G
from territory.operators import rings as R


def box(x, y, w=1.0, h=1.0):
    x, y, w, h = float(x), float(y), float(w), float(h)
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]


@pytest.fixture
def dissolve(spark):
    def make(*shapes, digits=4):
        df = spark.createDataFrame(list(shapes), f"key string, geom {G.GEOMETRY_TYPE}")
        out = R.outlines(df, "key", digits=digits)
        assert R.open_rings(out).count() == 0
        return {r.key: (r.geom, r.area) for r in out.withColumn("area", G.planar_area(F.col("geom"))).collect()}

    return make


def corners(ring):
    """Corners of a ring at which it turns."""
    body = ring[:-1]
    return {tuple(b) for a, b, c in zip(body[-1:] + body, body, body[1:] + body[:1]) if (b[0] - a[0]) * (c[1] - b[1]) != (b[1] - a[1]) * (c[0] - b[0])}


def test_borders_cancel_and_holes_find_their_ring(dissolve):
    frame = [[[box(x, y)]] for x in range(5) for y in range(5) if x in (0, 4) or y in (0, 4)]
    slanted = [[[0.0, 0.0], [4.0, 2.0], [0.0, 2.0], [0.0, 0.0]], [[0.0, 0.0], [2.0, 0.0], [2.0, 1.0], [0.0, 0.0]], [[2.0, 0.0], [4.0, 2.0], [2.0, 1.0], [2.0, 0.0]]]
    members = {
        "pair": [[[box(0, 0)]], [[box(1, 0)]]],
        "lone": [[[box(1, 0)]]],
        "turned": [[[box(0, 0)[::-1]]], [[box(1, 0)]]],
        "filled": [[[box(0, 0, 3, 3), box(1, 1)[::-1]]], [[box(1, 1)]]],
        "tall": [[[box(0, 0, 1, 3)]], *[[[box(1, i)]] for i in range(3)]],
        "slanted": [[[ring]] for ring in slanted],
        "frame": [*frame, [[box(2, 2)]], [[box(5, 5)]], [[box(20, 20, 9, 9), box(21, 21, 2, 2), box(25, 25)]]],
        "flat": [None, [[[[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]]],
    }
    got = dissolve(*[(key, geom) for key, shapes in members.items() for geom in shapes])
    assert "flat" not in got
    assert {k: area for k, (_, area) in got.items()} == {"pair": 2, "lone": 1, "turned": 2, "filled": 9, "tall": 6, "slanted": 6, "frame": 94}
    assert all(len(geom) == 1 and len(geom[0]) == 1 for k, (geom, _) in got.items() if k != "frame")
    assert corners(got["pair"][0][0][0]) == corners(got["turned"][0][0][0]) == {(0, 0), (2, 0), (2, 1), (0, 1)}
    # Vertices inside a neighbour's edge leave no border behind.
    assert corners(got["tall"][0][0][0]) == {(0, 0), (2, 0), (2, 3), (0, 3)}
    assert got["filled"][0] == [[box(0, 0, 3, 3)]]
    # An island in a hole and a box that touches a corner are parts of their own.
    geom = got["frame"][0]
    assert sorted(len(p) for p in geom) == [1, 1, 2, 3]
    assert corners(next(p for p in geom if len(p) == 2)[1]) == {(1, 1), (4, 1), (4, 4), (1, 4)}


def test_random_tiles(dissolve):
    """Random boxes of a lattice: areas, holes and parts as counted by flood fill."""
    rng = random.Random(1)
    cells = {(x, y) for x in range(14) for y in range(14) if rng.random() < 0.6}

    def components(of, steps):
        left, count = set(of), 0
        while left:
            stack, count = [left.pop()], count + 1
            while stack:
                x, y = stack.pop()
                for dx, dy in steps:
                    if (x + dx, y + dy) in left:
                        left.remove((x + dx, y + dy))
                        stack.append((x + dx, y + dy))
        return count

    four = [(1, 0), (-1, 0), (0, 1), (0, -1)]
    eight = [*four, (1, 1), (1, -1), (-1, 1), (-1, -1)]
    geom, area = dissolve(*[("k", [[box(x, y)]]) for x, y in cells])["k"]
    assert area == len(cells)
    assert len(geom) == components(cells, four)
    empty = {(x, y) for x in range(-1, 15) for y in range(-1, 15)} - cells
    # Empty places that touch in a corner share a border that meets itself there.
    assert sum(len(p) - 1 for p in geom) <= components(empty, four) - 1
    assert sum(len(p) - 1 for p in geom) == components(empty, eight) - 1


def test_a_long_ring(dissolve):
    n = 700
    top = [[float(i), 1.0 + i % 3] for i in range(n, -1, -1)]
    geom, area = dissolve(("k", [[[[0.0, 0.0], [float(n), 0.0], *top, [0.0, 0.0]]]]), digits=0)["k"]
    assert len(geom) == 1 and len(geom[0][0]) == n + 4
    assert geom[0][0][0] == [0.0, 0.0]


def test_null_keys_and_no_rows(spark):
    schema = f"key string, geom {G.GEOMETRY_TYPE}"
    assert R.outlines(spark.createDataFrame([], schema), "key").count() == 0
    none = spark.createDataFrame([(None, [[box(0, 0, 3, 3), box(1, 1)]])], schema)
    assert [(r.key, len(r.geom[0])) for r in R.outlines(none, "key").collect()] == [(None, 2)]


def test_edges_are_worked_out_once_by_all_tasks(spark):
    from territory.operators import rings

    corners = [[0.0, 0.0], [0.0, 2.0], [2.0, 2.0], [2.0, 0.0], [0.0, 0.0]]
    flat = [[0.0, 0.0], [1.0, 0.0], [2.0, 0.0], [0.0, 0.0]]
    polygons = spark.createDataFrame([("a", [[corners]]), ("a", [[flat]]), ("b", [])], "k string, geom array<array<array<array<double>>>>").coalesce(1)
    edges = rings.directed_edges(polygons, "k", "geom", 0)
    assert {tuple(r["a"]) + tuple(r["b"]) for r in edges.collect()} == {(0, 0, 2, 0), (2, 0, 2, 2), (2, 2, 0, 2), (0, 2, 0, 0)}
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan
    assert not [line for line in plan.splitlines() if line.strip(" :+-").startswith("Filter") and "aggregate(" in line]
