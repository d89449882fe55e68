"""Column functions: cleaning, parsing, banding, ratios and rounding.

All are compositions of built-in expressions, so they stay inside
whole-stage code generation and simple predicates reach the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from territory import settings as S

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -------------------------------------------------------------------


def clean_string(c: ColumnLike) -> Column:
    """Trim spaces; tabs and other blanks stay."""
    return F.trim(_c(c))


def blank_to_null(c: ColumnLike) -> Column:
    return F.nullif(clean_string(c), F.lit(""))


def is_filled(c: ColumnLike) -> Column:
    """Neither null nor blank."""
    return blank_to_null(c).isNotNull()


def blank_to_null_cast(c: ColumnLike, kind: str, lenient: bool = False) -> Column:
    """Cast text to ``kind``; blanks become null.

    A malformed value fails the query, or becomes null when ``lenient``.
    Whole numbers are cast as they are, so all 64 bits count; numbers written
    with decimals or an exponent are rounded, not refused.
    """
    text = blank_to_null(c)

    def to(column: Column, kind: str) -> Column:
        return column.try_cast(kind) if lenient else column.cast(kind)

    if kind in ("int", "integer", "bigint"):
        whole = text.rlike("^[+-]?[0-9]+$")
        return F.when(whole, to(text, kind)).otherwise(to(F.round(to(text, "decimal(38,18)")), kind))
    return to(text, kind)


def clean_numeric(c: ColumnLike) -> Column:
    """Decimal-comma text to double; the (case-sensitive) markers for missing
    and masked values become null."""
    text = F.replace(clean_string(c), F.lit(","), F.lit("."))
    return F.when(~text.isin(*S.MISSING_MARKERS), text).cast("double")


# --- dates ------------------------------------------------------------------


def parse_date(c: ColumnLike) -> Column:
    return clean_string(c).cast("date")


def year_of(c: ColumnLike) -> Column:
    return F.year(_c(c)).cast("int")


# --- predicates -------------------------------------------------------------


def is_one_of(c: ColumnLike, values: Iterable) -> Column:
    return _c(c).isin(*values)


def in_departments(c: ColumnLike, departments: Iterable[str] = S.DEPARTMENTS) -> Column:
    return is_one_of(c, departments)


def strictly_between(c: ColumnLike, low: float, high: float) -> Column:
    return (_c(c) > F.lit(low)) & (_c(c) < F.lit(high))


def in_city(code: ColumnLike) -> Column:
    """District codes of the central city."""
    return _c(code).startswith(S.CITY_PREFIX)


def in_inner_ring(
    include_city: bool = False,
    zone: ColumnLike | None = None,
    department: ColumnLike | None = None,
    code: ColumnLike | None = None,
) -> Column:
    """The inner ring around the city, with the city itself if asked for.

    A commune code gives its department; where only the zone is known, the
    city is the zone of its name.
    """
    if code is not None and department is None:
        department = department_of(code)
    if zone is None and department is None:
        raise ValueError("the ring needs a zone, a department or a commune code")
    ring, city = S.ZONE_NAMES[1], S.ZONE_NAMES[0]
    inside = is_one_of(department, S.INNER_RING) if zone is None else _c(zone) == ring
    if not include_city:
        return inside
    return inside | (_c(zone) == city if department is None else _c(department) == S.CITY_PREFIX[:2])


# --- codes ------------------------------------------------------------------


def department_of(code: ColumnLike) -> Column:
    return F.substring(_c(code), 1, 2)


def district_number(code: ColumnLike) -> Column:
    return F.right(_c(code), F.lit(2)).cast("int")


def district_code(number: ColumnLike) -> Column:
    return F.concat(F.lit(S.CITY_PREFIX), F.lpad(_c(number).cast("string"), 2, "0"))


def in_region(region: ColumnLike, code: str = S.REGION_CODE) -> Column:
    """Three-valued: null where the region is null."""
    return _c(region) == code


# --- bands and categories ---------------------------------------------------


def age_band(age: ColumnLike) -> Column:
    """Five-year bands ``00-04`` ... ``90-94``, then ``95+``; anything else
    is ``inconnu``."""
    low = (F.floor(_c(age) / 5) * 5).cast("int")
    return (
        F.when(_c(age) >= 95, "95+")
        .when(_c(age) >= 0, F.format_string("%02d-%02d", low, low + 4))
        .otherwise("inconnu")
    )


def crime_category(offence: ColumnLike) -> Column:
    """First matching rule wins; no match, and null, fall to the last group."""
    o = _c(offence)
    # Labels and patterns of the published indicator list.
    return (
        F.when(o.startswith("Vols"), "Vols")
        .when(o.contains("stupéfiants"), "Stupéfiants")
        .when(o.startswith("Violences"), "Violences")
        .when(
            o.isin("Cambriolages de logement", "Destructions et dégradations volontaires"),
            "Atteintes aux biens",
        )
        .otherwise("Escroqueries")
    )


# --- ratios and rounding ----------------------------------------------------


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Null instead of an error (or infinity) on a zero denominator."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def share(part: ColumnLike, total: ColumnLike, scale: float = 1.0, digits: int = 4) -> Column:
    ratio = safe_divide(part, total)
    return F.round(ratio if scale == 1.0 else ratio * F.lit(scale), digits)


def complement_rate(c: ColumnLike, digits: int = 1) -> Column:
    return F.round(F.lit(100.0) - _c(c), digits)


def pct_change(now: ColumnLike, before: ColumnLike, digits: int = 1) -> Column:
    return F.round(safe_divide(_c(now) - _c(before), before) * 100, digits)


def round_half_even(c: ColumnLike) -> Column:
    """Rounding of a binary double to a whole number, ties to even."""
    return F.rint(_c(c))


def total(c: ColumnLike, over: WindowSpec | None = None) -> Column:
    """Sum as a double, over any range of values."""
    summed = F.sum(_c(c).cast("double"))
    return summed if over is None else summed.over(over)


def weighted_mean(value: ColumnLike, weight: ColumnLike) -> Column:
    """Aggregate ``sum(v*w) / sum(w)``; a null value leaves the numerator
    only, its weight still counts."""
    product = _c(value) * _c(weight)
    return safe_divide(total(product), total(weight))
