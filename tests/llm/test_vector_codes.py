"""Product codes against plain integer arithmetic."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from territory.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int, codes string, error string, _ints string, _id int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{position in rows: (codes, error)} and codebooks, in Python integers."""
    ok = [(n, i, [math.floor(x * scale) for x in v]) for n, (i, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v)]
    ok.sort(key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    if not ok:
        return {}, []
    dim = len(ok[0][2])
    ok = [r for r in ok if len(r[2]) == dim and max(map(abs, r[2])) <= V.largest(dim)]
    spans = V.cuts(dim, parts)
    books = [[r[2][lo:hi] for r in ok[:entries]] for lo, hi in spans]

    def choose(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p, (lo, hi) in enumerate(spans):
            taken = {}
            for r in ok:
                taken.setdefault(choose(r[2][lo:hi], p)[1], []).append(r[2][lo:hi])
            for k, members in taken.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out = {}
    for n, _, q in ok:
        found = [choose(q[lo:hi], p) for p, (lo, hi) in enumerate(spans)]
        out[n] = ([k for _, k in found], sum(d for d, _ in found))
    return out, books


def check(spark, rows, **options):
    schema = SCHEMA
    df = spark.createDataFrame([(i, v, n, "c", "e", "i", 3) for n, (i, v) in enumerate(rows)], schema).repartition(3)
    coded, books = V.compress(df, **options)
    expected, expected_books = plain(rows, **options)
    got = {r.label: (r.codes, r.error) for r in coded.collect()}
    assert got == expected
    assert [b.tolist() for b in books] == expected_books or not expected
    assert "embedding" not in coded.columns and {"_ints", "_id", "vec_id"} <= set(coded.columns)
    return got


def vectors(n, dim, spread=1.0, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=dim) * spread).tolist()) for i in rng.permutation(n).tolist()]


def test_equals_plain_arithmetic(spark):
    check(spark, vectors(90, 64))


def test_components_of_several_limbs(spark):
    check(spark, vectors(40, 16, spread=20_000.0))


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5, -0.25] * 4
    rows = [(None, [1.0] * 8), (1, None), (2, []), (3, [nan] + [0.0] * 7), (4, [inf] * 8), (5, [None] + [0.0] * 7), (6, same), (6, same),
            (6, [0.1] * 8), (7, [1.0] * 9), (8, [1e300] * 8), (9, [-0.0001] * 8), (10, [1e6] * 8)]
    got = check(spark, rows)
    assert set(got) == {0, 6, 7, 8, 11}
    check(spark, [(i, [float(i % 3)] * 10) for i in range(30)])
    assert check(spark, rows[1:6]) == {}
    assert check(spark, []) == {}


def test_order_and_partitions_do_not_matter(spark):
    rows = vectors(200, 16)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    once, a = V.compress(df.repartition(1))
    again, b = V.compress(df.orderBy("embedding").repartition(7))
    assert V.books_digest(a) == V.books_digest(b)
    assert sorted(once.collect()) == sorted(again.collect())


def test_codes_bring_vectors_back_nearly(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.01).tolist()) for i in range(400)]
    coded, books = V.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted((r.vec_id, r.codes) for r in coded.collect())
    back = V.decode(np.array([c for _, c in got]), books)
    assert np.abs(back - np.array([v for _, v in sorted(rows)])).mean() < 0.1


BIG = (1 << 28) - 1


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(0, 28), st.integers(0, 2**32 - 1))
def test_dot_products_are_exact(terms, bits, seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(-(1 << bits), (1 << bits) + 1, (5, terms))
    b = rng.integers(-BIG, BIG + 1, (4, terms))
    expected = [[sum(x * y for x, y in zip(r, s, strict=True)) for s in b.tolist()] for r in a.tolist()]
    assert V.dot_products(a, b).tolist() == expected


@pytest.mark.parametrize("sign", [1, -1])
def test_extreme_values_stay_below_the_exact_range(sign):
    bits = (53 - 3) // 2
    for part in V.limbs(np.array([[sign * BIG] * 8, [-(1 << 27)] * 8]), bits):
        assert np.abs(part).max() ** 2 * 8 < 2**53
    values = np.full((2, 8), sign * V.largest(8))
    index, error = V.nearest(values, -values[:1])
    assert error.tolist() == [4 * 8 * V.largest(8) ** 2] * 2 and index.tolist() == [0, 0]
