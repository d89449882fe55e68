import random
import statistics

import pytest

from pyspark.sql import functions as F

from conftest import plan_of
from territory.operators import order_stats as O
from territory.operators import trend


def hot_frame(spark, n=6000):
    """Group ``a`` holds over a third of the rows; values repeat."""
    rng = random.Random(7)
    data = []
    for i in range(n):
        key = "a" if i % 5 < 2 else rng.choice("bcdefg")
        value = rng.choice([None, 0.0, rng.lognormvariate(10, 2), -rng.random(), 250000.0])
        data.append((i, key, value))
    data.append((n, "single", 3.5))
    return data, spark.createDataFrame(data, "id long, k string, v double")


def by_key(data):
    groups = {}
    for _, key, value in data:
        if value is not None:
            groups.setdefault(key, []).append(value)
    return groups


def test_median_of_even_group(rows):
    df = rows("k int, v double", *[(1, v) for v in (1.0, 2.0, 3.0, 10.0)])
    r = O.exact_medians(df, ["k"], {"m": F.col("v")}).first()
    assert (r["m_count"], r["m_median"], r["m_mean"], r["m_sum"]) == (4, 2.5, 4.0, 16.0)


def test_medians_match_brute_force(spark):
    data, df = hot_frame(spark)
    got = {r["k"]: r for r in O.exact_medians(df, ["k"], {"m": F.col("v"), "neg": -F.col("v")}).collect()}
    expected = by_key(data)
    assert set(got) == set(expected)
    for key, values in expected.items():
        assert got[key]["m_count"] == len(values)
        assert got[key]["m_median"] == statistics.median(values)
        assert got[key]["neg_median"] == -statistics.median(values)
        assert abs(got[key]["m_mean"] - statistics.fmean(values)) < 1e-6


def test_result_does_not_depend_on_chunks_or_partitions(spark, monkeypatch):
    _, df = hot_frame(spark, 1500)
    results = []
    for chunks, parts in ((16, 1), (64, 5), (1024, 9)):
        monkeypatch.setattr(O, "chunk_count", lambda _, c=chunks: c)
        frame = O.exact_medians(df.repartition(parts), ["k"], {"m": F.col("v")})
        results.append(sorted(frame.select("k", "m_count", "m_median", F.round("m_sum", 3)).collect()))
    assert results[0] == results[1] == results[2]


def test_all_values_equal(rows):
    df = rows("k int, v double", *[(1, 4.0)] * 9)
    r = O.exact_medians(df, ["k"], {"m": F.col("v")}).first()
    assert (r["m_median"], r["m_count"]) == (4.0, 9)


def test_group_without_values_is_absent_or_null(rows):
    df = rows("k int, v double", (1, None), (2, 1.0))
    got = {r["k"]: r for r in O.exact_medians(df, ["k"], {"m": F.col("v"), "one": F.lit(1.0)}).collect()}
    assert got[1]["m_median"] is None and got[1]["one_count"] == 1
    assert got[2]["m_median"] == 1.0


def test_null_key_is_a_group(rows):
    df = rows("k string, v double", (None, 1.0), (None, 3.0), ("a", 5.0))
    got = {r["k"]: r["m_median"] for r in O.exact_medians(df, ["k"], {"m": F.col("v")}).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_frequency_table_is_shuffled_once(spark):
    _, df = hot_frame(spark, 500)
    result = O.exact_medians(df, ["k"], {"m": F.col("v")})
    result.collect()
    plan = plan_of(result).split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 2
    assert plan.count("functions=[partial_count(1)]") == 1


def test_ranks_match_brute_force(spark):
    data, df = hot_frame(spark, 2000)
    groups = by_key(data)
    for r in O.value_ranks(df, ["k"], {"m": F.col("v")}).collect():
        values = groups[r["key"]["k"]]
        assert r["below"] == sum(v < r["value"] for v in values)
        assert r["n"] == values.count(r["value"])
        assert r["total"] == len(values)


def test_rank_and_percent_rank_match_window_functions(spark):
    from pyspark.sql import Window

    df = spark.range(400).select(
        "id", (F.col("id") % 3).alias("year"), ((F.col("id") * 37) % 50).cast("double").alias("x")
    )
    w = Window.partitionBy("year")
    expected = df.select(
        "id", "year",
        F.rank().over(w.orderBy(F.desc("x"))).cast("long").alias("rank"),
        F.percent_rank().over(w.orderBy("x")).alias("x"),
    )
    ranked = trend.rank_by(df, ["year"], "x", "rank").select("id", "year", "rank")
    percent = trend.percentile_columns(df, ["id", "year"], ["year"], {"x": F.col("x")})
    got = ranked.join(percent, ["id", "year"]).select("id", "year", "rank", "x")
    assert sorted(got.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("size", [1e-11, 1e15, 1e27])
def test_values_of_any_size(rows, size):
    df = rows("k int, v double", (1, size), (1, 3 * size))
    r = O.exact_medians(df, ["k"], {"m": F.col("v")}).first()
    assert (r.m_count, r.m_median) == (2, pytest.approx(2 * size))
    assert (r.m_sum, r.m_mean) == (pytest.approx(4 * size), pytest.approx(2 * size))


def test_no_task_merges_the_sketches_of_a_measure(spark):
    """Sketches are made per hash bucket; what meets per measure are a few picked values."""
    _, df = hot_frame(spark, 500)
    plan = plan_of(O._add_chunk(O.value_counts(df, ["k"], {"m": F.col("v")}), 256))
    sketched = [line for line in plan.splitlines() if "percentile_approx" in line and "Aggregate" in line]
    assert sketched and all("," in line.split("keys=[")[1].split("]")[0] for line in sketched)
