"""Parameters and fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------

REGION_CODE = "11"
DEPARTMENTS = ("75", "77", "78", "91", "92", "93", "94", "95")
INNER_RING = ("92", "93", "94")
OUTER_RING = ("77", "78", "91", "95")
CITY_PREFIX = "751"
CITY_CODE = "75056"

ZONES = (
    ("75", "Paris"),
    ("77", "Grande couronne"),
    ("78", "Grande couronne"),
    ("91", "Grande couronne"),
    ("92", "Petite couronne"),
    ("93", "Petite couronne"),
    ("94", "Petite couronne"),
    ("95", "Grande couronne"),
)
ZONE_NAMES = ("Paris", "Petite couronne", "Grande couronne")

DEPARTMENT_NAMES = (
    ("75", "Paris"),
    ("77", "Seine-et-Marne"),
    ("78", "Yvelines"),
    ("91", "Essonne"),
    ("92", "Hauts-de-Seine"),
    ("93", "Seine-Saint-Denis"),
    ("94", "Val-de-Marne"),
    ("95", "Val-d'Oise"),
)

SALE = "Vente"
FLAT = "Appartement"
HOUSE = "Maison"
COMMUNE_TYPES = ("COM", "ARM")
PUBLISHED = "diff"
ALL_AGES = "ENS"
MISSING_MARKERS = ("", "s", "nd", "NA")

# Square degrees to square kilometres at the latitude of the region.
KM_PER_DEGREE = 111.12
LATITUDE_FACTOR = 0.6583

# Weights of the tension index: purchase effort, price per square metre
# against monthly income, low share of 25-39 year olds, poverty.
TENSION_WEIGHTS = (0.40, 0.30, 0.15, 0.15)


# --- Parameters -------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    """Outlier bounds (both exclusive), first year and smallest group kept."""

    price_min: float = 1000
    price_max: float = 50_000_000
    area_min: float = 5
    area_max: float = 5000
    year_min: int = 2018
    sales_min: int = 5
    rooms_price_min: float = 10_000


@dataclass(frozen=True)
class Periods:
    """Years that the serving queries look at."""

    latest: int = 2025
    crime: int = 2024
