import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from territory.functions import clean as C


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_clean_numeric_markers(rows):
    df = rows("x string", (" 12,5 ",), ("",), ("s",), ("nd",), ("NA",), (None,), ("3",))
    assert column(df, C.clean_numeric("x")) == [12.5, None, None, None, None, None, 3.0]


def test_markers_are_case_sensitive(rows):
    with pytest.raises(PySparkException):
        column(rows("x string", ("S",)), C.clean_numeric("x"))


def test_clean_string_trims_spaces_only(rows):
    assert column(rows("x string", ("  a\t ",)), C.clean_string("x")) == ["a\t"]


def test_blank_cast_strict_and_lenient(rows):
    df = rows("x string", (" 3 ",), ("  ",), (None,), ("12.6",))
    assert column(df, C.blank_to_null_cast("x", "int")) == [3, None, None, 13]
    bad = rows("x string", ("abc",))
    assert column(bad, C.blank_to_null_cast("x", "double", lenient=True)) == [None]
    with pytest.raises(PySparkException):
        column(bad, C.blank_to_null_cast("x", "double"))


def test_safe_divide(rows):
    df = rows("n double, d double", (1.0, 0.0), (1.0, 4.0), (None, 1.0), (1.0, None))
    assert column(df, C.safe_divide("n", "d")) == [None, 0.25, None, None]


def test_age_bands(rows):
    df = rows("a int", (0,), (4,), (5,), (94,), (95,), (120,), (-1,), (None,))
    assert column(df, C.age_band("a")) == [
        "00-04", "00-04", "05-09", "90-94", "95+", "95+", "inconnu", "inconnu"
    ]


def test_nineteen_bands_and_the_open_one(spark):
    bands = column(spark.range(0, 110).select(F.col("id").cast("int").alias("a")), C.age_band("a"))
    assert len(set(bands)) == 20


def test_crime_categories_in_order(rows):
    df = rows(
        "o string", ("Vols de véhicules",), ("Usage de stupéfiants",), ("Violences sexuelles",),
        ("Cambriolages de logement",), ("Destructions et dégradations volontaires",),
        ("Escroqueries",), (None,), ("Vols et stupéfiants",),
    )
    assert column(df, C.crime_category("o")) == [
        "Vols", "Stupéfiants", "Violences", "Atteintes aux biens", "Atteintes aux biens",
        "Escroqueries", "Escroqueries", "Vols",
    ]


def test_rounding_rules(rows):
    df = rows("x double", (0.5,), (1.5,), (2.5,), (-0.5,))
    assert column(df, F.round("x")) == [1.0, 2.0, 3.0, -1.0]
    assert column(df, C.round_half_even("x")) == [0.0, 2.0, 2.0, -0.0]
    assert column(rows("x double", (1.005,)), F.round("x", 2)) == [1.01]


def test_codes(rows):
    df = rows("c string, n int", ("75104", 4))
    assert column(df, C.district_code("n")) == ["75104"]
    assert column(df, C.district_number("c")) == [4]
    assert column(df, C.department_of("c")) == ["75"]


def test_inner_ring_with_and_without_city(rows):
    df = rows("z string, d string, c string",
              ("Petite couronne", "92", "92001"), ("Paris", "75", "75101"), ("Grande couronne", "77", "77001"))
    for include, expected in ((False, [True, False, False]), (True, [True, True, False])):
        assert column(df, C.in_inner_ring(include, zone="z", department="d")) == expected
        assert column(df, C.in_inner_ring(include, department="d")) == expected
        assert column(df, C.in_inner_ring(include, code="c")) == expected
    with pytest.raises(ValueError):
        C.in_inner_ring()


def test_region_flag_is_three_valued(rows):
    assert column(rows("r string", ("11",), ("32",), (None,)), C.in_region("r")) == [True, False, None]


def test_dates(rows):
    df = rows("d string", (" 2024-01-15 ",))
    assert column(df, C.parse_date("d")) == [datetime.date(2024, 1, 15)]
    assert column(df, C.year_of(C.parse_date("d"))) == [2024]


def test_weighted_mean_keeps_weight_of_missing_value(rows):
    df = rows("v double, w double", (10.0, 1.0), (None, 1.0))
    assert df.agg(C.weighted_mean("v", "w")).first()[0] == 5.0
    assert rows("v double, w double", (1.0, 0.0)).agg(C.weighted_mean("v", "w")).first()[0] is None


@pytest.mark.parametrize("size", [1e-13, 1.0, 1e15, 1e27])
def test_sums_and_means_of_any_size(rows, size):
    df = rows("v double, w double", (3.0 * size, 1e-13), (6.0 * size, 2e-13))
    r = df.agg(C.total("v").alias("t"), C.weighted_mean("v", "w").alias("m")).first()
    assert r.t == pytest.approx(9 * size, rel=1e-12)
    assert r.m == pytest.approx(5 * size, rel=1e-12)


def test_whole_numbers_keep_all_bits(rows):
    df = rows("n string", ("9007199254740993",), (" -9223372036854775808 ",), ("2.5",), ("1e3",), ("",), (None,))
    found = column(df, C.blank_to_null_cast("n", "bigint"))
    assert found == [9007199254740993, -9223372036854775808, 3, 1000, None, None]
    assert column(rows("n string", ("x",), ("99999999999999999999",)), C.blank_to_null_cast("n", "int", lenient=True)) == [None, None]
