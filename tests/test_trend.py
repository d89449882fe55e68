from pyspark.sql import functions as F

from territory.operators import trend


def test_previous_skips_a_removed_period(rows):
    df = rows("c string, y int, n int, p double", ("a", 2021, 8, 100.0), ("a", 2022, 3, 50.0), ("a", 2023, 9, 120.0))
    kept = df.filter("n >= 5")
    got = {r["y"]: r["prev"] for r in trend.with_previous(kept, "c", "y", {"p": "prev"}).collect()}
    assert got == {2021: None, 2023: 100.0}


def test_cumulative_change(rows):
    df = rows("c string, y int, p double", ("a", 1, 100.0), ("a", 2, 110.0), ("a", 3, 90.0), ("b", 1, 0.0), ("b", 2, 5.0))
    got = {(r["c"], r["y"]): r["cum"] for r in trend.cumulative_change(df, "c", "y", "p", "cum").collect()}
    assert got == {("a", 1): 0.0, ("a", 2): 10.0, ("a", 3): -10.0, ("b", 1): None, ("b", 2): None}


def test_composite_index(rows):
    df = rows(
        "c string, y int, a double, b double",
        ("x", 1, 1.0, 9.0), ("y", 1, 2.0, 5.0), ("z", 1, 3.0, 1.0), ("n", 1, None, 1.0), ("x", 2, 1.0, 1.0),
    )
    parts = {"a": (F.col("a"), 0.6), "b": (-F.col("b"), 0.4)}
    got = trend.composite_index(df, ["c", "y"], ["y"], parts, "index")
    assert {(r["c"], r["y"]): r["index"] for r in got.collect()} == {
        ("x", 1): 0.0, ("y", 1): 50.0, ("z", 1): 100.0, ("x", 2): 0.0
    }
