import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from territory.operators import aggregate as A
from territory.operators import dedup, incremental, joins, quality

DAY = datetime.date


def test_keep_largest_nulls_last(rows):
    df = rows("id int, area double, lot int", (1, 20.0, 1), (1, 45.0, 2), (1, None, 3), (2, None, 1))
    got = dedup.keep_largest(df, "id", "area", ["lot"])
    assert sorted((r["id"], r["area"]) for r in got.collect()) == [(1, 45.0), (2, None)]


def test_keep_largest_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("id"), F.col("id").cast("double").alias("area"))
    plan = plan_of(dedup.keep_largest(df, "id", "area"))
    assert plan.count("WindowGroupLimit") == 2


def test_price_stats(rows):
    df = rows(
        "c string, p double, a double, k string",
        ("x", 100.0, 10.0, "A"), ("x", 300.0, 10.0, "B"), ("x", 200.0, 40.0, "A"), ("y", 10.0, 5.0, "B"),
    )
    got = {r["c"]: r for r in A.price_stats(df, ["c"], "p", "a", "k", {"na": "A", "nb": "B"}).collect()}
    x = got["x"]
    assert (x["nb_ventes"], x["na"], x["nb"]) == (3, 2, 1)
    assert (x["prix_median"], x["prix_moyen"], x["prix_m2_median"], x["surface_mediane"]) == (200.0, 200.0, 10.0, 10.0)
    assert got["y"]["na"] == 0


def test_rate_per_thousand_takes_one_population(rows):
    df = rows("c string, n double, p double", ("x", 3.0, 1000.0), ("x", None, 1000.0), ("x", 2.0, 1000.0), ("z", 1.0, 0.0))
    got = {r["c"]: (r["facts"], r["rate"]) for r in A.rate_per_thousand(df, ["c"], "n", "p").collect()}
    assert got == {"x": (5.0, 5.0), "z": (1.0, None)}


def test_rate_on_repeated_population_is_a_mean_rate(rows):
    df = rows("n double, p double", (10.0, 1000.0), (30.0, 1000.0))
    assert df.agg(A.rate_on_sums("n", "p")).first()[0] == 20.0


def test_shares_of_total_include_the_unknown(rows):
    df = rows("c string, b string, n double", ("x", "25-29", 1.0), ("x", "inconnu", 3.0))
    r = A.shares_of_total(df, "c", "n", {"young": F.col("b") == "25-29"}).first()
    assert (r["total"], r["pop_young"], r["part_young"]) == (4.0, 1.0, 0.25)


def test_sum_in_period_is_half_open(rows):
    df = rows("id int, d date, n double", (1, DAY(2026, 3, 1), 1.0), (1, DAY(2026, 3, 31), 2.0), (1, DAY(2026, 4, 1), 4.0))
    assert A.sum_in_period(df, ["id"], "d", "2026-03-01", "2026-04-01", "n", "t").first()["t"] == 3.0


def test_latest_only_skips_a_year_without_values(rows):
    df = rows("y int, r double", (2023, 1.0), (2024, None), (2023, None))
    assert [tuple(r) for r in joins.latest_only(df, "y", F.col("r").isNotNull()).collect()] == [(2023, 1.0)]


def test_lookup_last_drops_rows_without_position(rows):
    counters = rows("id int, n int", (1, 10), (2, 20), (3, 30))
    places = rows("id int, seq int, lat double", (1, 1, 5.0), (1, 2, 6.0), (2, 1, 7.0), (2, 2, None))
    got = joins.lookup_last(counters, places, "id", F.col("seq"), "lat")
    assert [(r["id"], r["lat"]) for r in got.collect()] == [(1, 6.0)]


def test_top_k_breaks_ties_by_key(rows):
    df = rows("k string, n int", ("c", 5), ("a", 5), ("b", 9), ("d", None))
    assert [r["k"] for r in joins.top_k(df, "n", 2, ["k"]).collect()] == ["b", "a"]


def sales(rows, *values):
    return rows("id string, day date, v int", *values)


def test_incremental_is_strict_and_replaces_keys(rows):
    stored = sales(rows, ("a", DAY(2024, 1, 10), 1), ("b", DAY(2024, 1, 31), 2), ("b", DAY(2024, 1, 31), 3))
    incoming = rows(
        "id string, day date, v int, extra string",
        ("c", DAY(2024, 1, 31), 9, "same day"), ("b", DAY(2024, 2, 1), 7, "x"), ("b", DAY(2024, 2, 1), 8, "y"),
    )
    got = sorted(tuple(r) for r in incremental.incremental_load(stored, incoming, "day", "id").collect())
    assert got == [
        ("a", DAY(2024, 1, 10), 1, None), ("b", DAY(2024, 2, 1), 7, "x"), ("b", DAY(2024, 2, 1), 8, "y")
    ]


def test_incremental_into_an_empty_table_loads_all(rows, spark):
    stored = spark.createDataFrame([], "id string, day date, v int")
    incoming = sales(rows, ("a", DAY(2024, 1, 1), 1), ("b", None, 2))
    assert incremental.incremental_load(stored, incoming, "day", "id").count() == 2


def test_versioned_load(spark, rows, tmp_path):
    root = str(tmp_path / "sales")
    incremental.load_version(spark, root, sales(rows, ("a", DAY(2023, 5, 1), 1), ("b", DAY(2024, 1, 1), 2)), "day", "id", 1)
    second = incremental.load_version(spark, root, sales(rows, ("a", DAY(2024, 3, 1), 5), ("z", DAY(2023, 1, 1), 6)), "day", "id", 2)
    assert sorted((r["id"], r["v"]) for r in second.collect()) == [("a", 5), ("b", 2)]
    assert incremental.read_version(spark, root, 1).count() == 2


def test_quality_checks(rows):
    df = rows("k string, v int", ("a", 1), ("a", None), ("b", 3), (None, 4))
    assert quality.check_not_null(df, "v").count() == 1
    assert [tuple(r) for r in quality.check_unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.check_accepted_values(df, "k", ["a"]).collect()] == [("b", 1)]
    parent = rows("k string", ("a",), ("a",))
    assert [r["k"] for r in quality.check_relationship(df, parent, "k").collect()] == ["b"]
    assert quality.check_expression(df, F.col("v") > 2).count() == 2
    assert {r["table_name"]: r["n"] for r in quality.row_counts({"x": df, "y": parent}).collect()} == {"x": 4, "y": 2}


def test_freshness_states(rows, spark):
    df = rows("d date", (DAY(2024, 1, 1),), (DAY(2023, 1, 1),))
    states = {
        day: quality.check_freshness(df, "d", F.lit(day).cast("date"), 90, 180).first()["status"]
        for day in ("2024-03-31", "2024-04-01", "2024-07-01")
    }
    assert states == {"2024-03-31": "pass", "2024-04-01": "warn", "2024-07-01": "error"}
    empty = spark.createDataFrame([], "d date")
    assert quality.check_freshness(empty, "d", F.lit("2024-01-01").cast("date"), 1, 2).first()["status"] == "error"


def test_a_load_leaves_the_files_of_other_years_alone(spark, rows, tmp_path):
    root = str(tmp_path / "store")
    day = lambda t: datetime.date.fromisoformat(t)
    first = rows("k int, day date, v string", *[(i, day(f"{2019 + i % 4}-03-0{1 + i % 9}"), "old") for i in range(40)], (99, None, "undated"))
    incremental.load_version(spark, root, first, "day", "k", 1)
    files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store" / "data").rglob("*.parquet")}
    late = rows("k int, day date, v string", (1, day("2023-01-01"), "new"), (50, day("2023-01-02"), "new"), (2, day("2018-01-01"), "too late"))
    second = incremental.load_version(spark, root, late, "day", "k", 2)
    expected = {(i, "old") for i in range(40) if i != 1} | {(99, "undated"), (1, "new"), (50, "new")}
    assert {(r.k, r.v) for r in second.collect()} == expected
    listed = {p.removeprefix("file:").replace("///", "/") for p in second.inputFiles()}
    kept = {p for p in files if "_year=2020" not in p}
    assert kept <= listed and not (set(files) - kept) & listed
    assert all(Path(p).stat().st_mtime_ns == at for p, at in files.items())
    assert {(r.k, r.v) for r in incremental.read_version(spark, root, 1).collect()} == {(i, "old") for i in range(40)} | {(99, "undated")}
    third = incremental.load_version(spark, root, late, "day", "k", 3)
    assert {(r.k, r.v) for r in third.collect()} == expected and not (tmp_path / "store" / "data" / "v3").exists()


def test_a_load_opens_only_files_that_can_hold_its_keys(spark, tmp_path):
    import random

    from territory.operators import incremental

    root, rng = str(tmp_path / "t"), random.Random(4)
    keys = [f"k{rng.randrange(10**9)}" for _ in range(6000)]
    days = [f"{2001 + i % 6}-03-04" for i in range(6000)]
    old = spark.createDataFrame(list(zip(keys, days, strict=True)), "key string, day string").withColumn("day", F.to_date("day"))
    incremental.load_version(spark, root, old, "day", "key", 1)
    folders = [f"data/v1/_year={y}" for y in range(2001, 2007)]

    def opened(*asked):
        df = spark.createDataFrame([(k,) for k in asked], "key string")
        return {f.split("/")[2] for f in incremental.files_with_keys(spark, root, folders, df)}

    for i in range(0, 6000, 1500):
        assert f"_year={2001 + i % 6}" in opened(keys[i])
    assert opened(keys[0], keys[6], None) == {"_year=2001"}
    assert opened(*keys) == {f"_year={y}" for y in range(2001, 2007)}
    assert opened("a", "zz") == opened(None) == opened() == set()
    assert sum(len(opened(*[f"k{rng.randrange(10**9)}" for _ in range(20)])) for _ in range(3)) <= 4
    new = spark.createDataFrame([(keys[1], "2030-01-01"), ("k_new", "2030-01-02"), (None, "2030-01-02")], "key string, day string")
    incremental.load_version(spark, root, new.withColumn("day", F.to_date("day")), "day", "key", 2)
    manifest = {r.year: r.folder for r in spark.read.parquet(f"{root}/manifest/v2").collect()}
    assert {y for y, f in manifest.items() if f.startswith("data/v2")} == {"2002", "2030"}
    assert incremental.read_version(spark, root, 2).count() == 6002
    incremental.drop_version(spark, root, 2)
    assert incremental.read_version(spark, root, 1).count() == 6000


def test_key_rules_by_one_exchange(spark, rows):
    from conftest import plan_of
    from territory.operators import quality as Q

    parent = rows("id int", (1,), (2,), (2,), (None,), (5,), (5,), (5,))
    child = rows("ref int", (1,), (1,), (3,), (3,), (None,), (4,))
    found = Q.check_keys(
        {"p": (parent, "id"), "c": (child, "ref"), "none": (child.filter("false"), "ref")},
        unique={"p_unique": "p", "c_unique": "c", "none_unique": "none"}, references={"c_known": ("c", "p"), "none_known": ("none", "p")},
    )
    assert {r.table_name: r.n for r in found.collect()} == {"p_unique": 2, "c_unique": 2, "none_unique": 0, "c_known": 3, "none_known": 0}
    assert Q.check_unique(parent, "id").count() == 2 and Q.check_relationship(child.withColumnRenamed("ref", "id"), parent, "id").count() == 3
    plan = plan_of(found)
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_file_ages(spark, tmp_path):
    from territory.operators import quality as Q

    spark.range(3).write.parquet(str(tmp_path / "t"))
    today = F.current_date()
    states = [Q.check_file_age(spark, str(tmp_path / "t"), F.date_add(today, d), 365, 730).first() for d in (0, 400, 800)]
    assert [s.status for s in states] == ["pass", "warn", "error"] and states[1].age_days == 400


def test_inner_ring_perimeter(rows):
    from territory.functions import clean as C

    df = rows("zone string, dep string, code string", ("Petite couronne", "92", "92001"), ("Paris", "75", "75101"), ("Grande couronne", "77", "77001"), (None, None, None))
    for scope in ({"zone": "zone"}, {"department": "dep"}, {"code": "code"}, {"zone": "zone", "code": "code"}):
        for city, expected in ((False, [True, False, False, None]), (True, [True, True, False, None])):
            assert [r[0] for r in df.select(C.in_inner_ring(city, **scope)).collect()] == expected
    with pytest.raises(ValueError):
        C.in_inner_ring()


def test_key_filters_are_added_up_without_a_sort(spark, tmp_path):
    root = str(tmp_path / "store")
    df = spark.range(4000).selectExpr("id * 7 as k", "date'2020-01-01' as day")
    incremental.load_version(spark, root, df, "day", "k", 1)
    folders = ["data/v1/_year=2020"]
    assert all(incremental.files_with_keys(spark, root, folders, spark.range(i, i + 1).selectExpr("id * 7 as k")) for i in (0, 1999, 3999))
    absent = spark.range(27_000).filter("id % 7 != 0").selectExpr("id as k")
    filters = spark.read.parquet(f"{root}/keys/v1/filters")
    words = filters.agg(F.max("words")).first()[0]
    hit = absent.withColumn("word", incremental._word(F.col("k"), F.lit(words))).withColumn("mask", incremental._mask(F.col("k")))
    met = hit.join(filters, "word").filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    assert met.count() < 0.03 * absent.count()
    # Numbers only: what holds text or binary buffers is sorted by one task before it is added up.
    assert {t for _, t in filters.dtypes} == {"bigint"}
