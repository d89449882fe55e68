"""Dashboard queries over the result tables.

A handful of parameterised shapes, and one catalogue entry per dashboard card.
Column names are the labels shown to readers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from territory import settings as S
from territory.functions import clean as C
from territory.operators.aggregate import rate_on_sums
from territory.operators.joins import latest_only, members_of, top_k

# Labels.
YEAR, ZONE, DEPARTMENT, CODE, NAME = "Année", "Zone", "Département", "Code commune", "Commune"
PRICE_M2, SALES, RATIO = "Prix au m² (€)", "Nombre de ventes", "Ratio prix / revenu (années)"
YOUNG, SENIOR = "Part des 25–39 ans (%)", "Part des 60 ans et plus (%)"
INCOME, AREA, RENT = "Revenu médian (€)", "Surface médiane (m²)", "Loyer au m² (€)"
CRIME, CATEGORY = "Faits pour 1 000 hab.", "Catégorie"
HIGHER, NO_DIPLOMA = "Diplômés du supérieur (%)", "Sans diplôme (%)"


@dataclass(frozen=True)
class Tables:
    """Result tables that the cards read; mobility tables are optional."""

    accessibility: DataFrame
    zones: DataFrame
    evolution: DataFrame
    crime_detail: DataFrame
    city_rooms: DataFrame
    diplomas: DataFrame
    transit: DataFrame | None = None
    cycle: DataFrame | None = None
    periods: S.Periods = field(default_factory=S.Periods)

    def latest(self) -> DataFrame:
        return self.accessibility.filter(F.col("annee") == self.periods.latest)


class TablesOnDemand(Tables):
    """The same over tables by name, each taken when a card reads it: one that makes
    its tables on demand (``build_models``) makes those of the card only."""

    def __init__(self, named: Mapping[str, DataFrame], periods: S.Periods):
        object.__setattr__(self, "named", named)
        object.__setattr__(self, "periods", periods)

    def __getattribute__(self, name: str):
        named = object.__getattribute__(self, "named") if name in _TABLE_NAMES else {}
        return named[name] if name in named else object.__getattribute__(self, name)


_TABLE_NAMES = frozenset(f.name for f in fields(Tables)) - {"periods"}


# --- shapes -----------------------------------------------------------------


def year_label() -> Column:
    return F.col("annee").cast("string").alias(YEAR)


def percent(column: str, label: str) -> Column:
    return F.round(F.col(column) * 100, 1).alias(label)


def whole(column: str, label: str) -> Column:
    return F.round(F.col(column)).alias(label)


def weighted(value: str, weight: str, label: str, digits: int, scale: float = 1.0) -> Column:
    """Rounded weighted mean as an aggregate column."""
    mean = C.weighted_mean(value, weight)
    return F.round(mean if scale == 1.0 else mean * F.lit(scale), digits).alias(label)


def weighted_by(df: DataFrame, group: str, label: str, means: Sequence[Column],
                present: Sequence[str] = ()) -> DataFrame:
    """Weighted indicators per group, rows lacking a ``present`` column left out."""
    for column in present:
        df = df.filter(F.col(column).isNotNull())
    return df.groupBy(F.col(group).alias(label)).agg(*means).orderBy(label)


def zone_series(zones: DataFrame, value: Column) -> DataFrame:
    """One measure by year and zone."""
    return zones.select(year_label(), F.col("zone_idf").alias(ZONE), value).orderBy(YEAR, ZONE)


def crime_by_category(rows: DataFrame, keys: Sequence[Column], name: str) -> DataFrame:
    """Rate per category. Each offence row repeats its commune's population,
    so this is a mean rate over offences."""
    category = C.crime_category("type_delit").alias(CATEGORY)
    return rows.groupBy(*keys, category).agg(rate_on_sums("nb_faits", "population").alias(name))


def crime_in_scope(t: Tables, scope: Column, year: int | None = None) -> DataFrame:
    """Offence rows of commune-years in the accessibility table and scope."""
    kept = t.accessibility.filter(scope).select("code_commune", "annee")
    rows = t.crime_detail if year is None else t.crime_detail.filter(F.col("annee") == year)
    return rows.join(kept, ["code_commune", "annee"])


def latest_crime(t: Tables) -> DataFrame:
    return latest_only(t.accessibility, "annee", F.col("taux_delinquance_pour_mille").isNotNull())


def in_scope(df: DataFrame, scope: Column, columns: Sequence[Column],
             present: Sequence[str] = ()) -> DataFrame:
    """Chosen columns of the rows in a perimeter."""
    for column in present:
        df = df.filter(F.col(column).isNotNull())
    return df.filter(scope).select(*columns)


def with_diplomas(t: Tables) -> DataFrame:
    return t.latest().join(t.diplomas, "code_commune")


def rent_estimate(t: Tables, rooms: int) -> DataFrame:
    """Monthly rent of a city flat: rent per square metre times median area."""
    sizes = t.city_rooms.filter(F.col("nb_pieces") == rooms).select(
        "code_commune", "annee", F.col("surface_mediane").alias("_area")
    )
    rows = t.latest().filter(F.col("loyer_m2_median").isNotNull())
    rent = F.round(F.col("loyer_m2_median") * F.col("_area")).alias("Loyer mensuel (€)")
    return rows.join(sizes, ["code_commune", "annee"]).select(F.col("code_commune").alias(CODE), rent)


def label(name: str) -> Column:
    """Output column by its label; labels may hold dots."""
    return F.col(f"`{name}`")


def by_code(column: Column) -> list[Column]:
    return [F.col("code_commune").alias(CODE), column]


def city(column: str = "code_commune") -> Column:
    return C.in_city(column)


def ring(include_city: bool) -> Column:
    return C.in_inner_ring(include_city, zone="zone_idf", department="code_departement")


# --- region -----------------------------------------------------------------

_PRICE = ("prix_m2_median", "nb_ventes", PRICE_M2, 0)


def region_price_by_department(t: Tables) -> DataFrame:
    sales = F.sum("nb_ventes").cast("int").alias(SALES)
    return weighted_by(t.latest(), "code_departement", DEPARTMENT, [weighted(*_PRICE), sales])


def region_young_by_department(t: Tables) -> DataFrame:
    mean = weighted("part_25_39", "population_2021", YOUNG, 1, 100)
    return weighted_by(t.latest(), "code_departement", DEPARTMENT, [mean], ["part_25_39"])


def region_zone_table(t: Tables) -> DataFrame:
    return t.zones.select(
        F.col("zone_idf").alias(ZONE), year_label(),
        F.col("nb_communes").alias("Nombre de communes"),
        F.col("nb_ventes_total").alias(SALES),
        whole("prix_m2_median_pondere", PRICE_M2),
        whole("niveau_vie_median_pondere", "Niveau de vie médian (€)"),
        F.round("ratio_achat_revenu_pondere", 1).alias(RATIO),
        percent("part_25_39_ponderee", YOUNG),
    ).orderBy(F.col(YEAR).desc_nulls_first(), F.col(ZONE).asc_nulls_last())


def region_price_series(t: Tables) -> DataFrame:
    return zone_series(t.zones, whole("prix_m2_median_pondere", PRICE_M2))


def region_sales_series(t: Tables) -> DataFrame:
    return zone_series(t.zones, F.col("nb_ventes_total").alias(SALES))


def region_price_and_young(t: Tables) -> DataFrame:
    means = [weighted(*_PRICE), weighted("part_25_39", "population_2021", YOUNG, 1, 100)]
    return weighted_by(t.latest(), "code_departement", DEPARTMENT, means, ["part_25_39"])


def region_ratio_series(t: Tables) -> DataFrame:
    return zone_series(t.zones, F.round("ratio_achat_revenu_pondere", 1).alias(RATIO))


def region_area_series(t: Tables) -> DataFrame:
    area = C.round_half_even(C.weighted_mean("surface_mediane", "nb_ventes")).alias(AREA)
    keys = [year_label(), F.col("zone_idf").alias(ZONE)]
    return t.accessibility.groupBy(*keys).agg(area).orderBy(YEAR, ZONE)


def region_rent_by_department(t: Tables) -> DataFrame:
    mean = weighted("loyer_m2_median", "nb_ventes", RENT, 1)
    return weighted_by(t.latest(), "code_departement", DEPARTMENT, [mean], ["loyer_m2_median"])


def region_rent_against_purchase(t: Tables) -> DataFrame:
    rent = weighted("loyer_m2_median", "nb_ventes", "Loyer au m² (€/mois)", 1)
    monthly = C.weighted_mean("prix_m2_median", "nb_ventes") / 12
    means = [rent, F.round(monthly).alias("Mensualité d'achat au m² (€)")]
    return weighted_by(t.latest(), "zone_idf", ZONE, means, ["loyer_m2_median"])


def region_crime_by_department(t: Tables) -> DataFrame:
    rate = rate_on_sums("nb_faits_delinquance", "population_2021").alias(CRIME)
    return weighted_by(latest_crime(t), "code_departement", DEPARTMENT, [rate])


def region_crime_series(t: Tables) -> DataFrame:
    rate = rate_on_sums("nb_faits_delinquance", "population_2021").alias(CRIME)
    rows = t.accessibility.filter(F.col("taux_delinquance_pour_mille").isNotNull())
    return rows.groupBy(year_label(), F.col("zone_idf").alias(ZONE)).agg(rate).orderBy(YEAR, ZONE)


def region_crime_by_category(t: Tables) -> DataFrame:
    rows = crime_in_scope(t, F.col("zone_idf").isNotNull(), t.periods.crime)
    return crime_by_category(rows, [], CRIME).orderBy(label(CRIME).desc_nulls_first(), CATEGORY)


def region_category_series(t: Tables) -> DataFrame:
    rows = crime_in_scope(t, F.col("zone_idf").isNotNull())
    return crime_by_category(rows, [year_label()], "taux").orderBy(YEAR, CATEGORY)


def region_senior_by_department(t: Tables) -> DataFrame:
    mean = weighted("part_60_plus", "population_2021", SENIOR, 1, 100)
    return weighted_by(t.latest(), "code_departement", DEPARTMENT, [mean], ["part_60_plus"])


def region_higher_education(t: Tables) -> DataFrame:
    mean = weighted("part_etudes_sup", "pop_15p_non_scol", HIGHER, 1)
    return weighted_by(with_diplomas(t), "code_departement", DEPARTMENT, [mean], ["part_etudes_sup"])


def region_no_diploma(t: Tables) -> DataFrame:
    mean = weighted("part_sans_diplome", "pop_15p_non_scol", NO_DIPLOMA, 1)
    return weighted_by(with_diplomas(t), "code_departement", DEPARTMENT, [mean], ["part_sans_diplome"])


# --- city -------------------------------------------------------------------


def city_price(t: Tables) -> DataFrame:
    return in_scope(t.latest(), city(), by_code(whole("prix_m2_median", PRICE_M2)))


def city_young(t: Tables) -> DataFrame:
    return in_scope(t.latest(), city(), by_code(percent("part_25_39", YOUNG)))


def city_price_series(t: Tables) -> DataFrame:
    columns = [year_label(), F.col("nom_commune").alias(NAME), whole("prix_m2_median", PRICE_M2)]
    return in_scope(t.evolution, city(), columns).orderBy(YEAR, NAME)


def city_detail(t: Tables) -> DataFrame:
    rows = t.latest().filter(city()).orderBy(F.col("prix_m2_median").desc_nulls_first())
    return rows.select(
        F.col("nom_commune").alias(NAME), whole("prix_m2_median", PRICE_M2),
        F.col("nb_ventes").alias(SALES), percent("part_25_39", YOUNG),
        whole("niveau_vie_median", INCOME), F.round("surface_mediane", 1).alias(AREA),
    )


def city_area(t: Tables) -> DataFrame:
    rows = t.latest().filter(city()).orderBy(F.col("surface_mediane").desc_nulls_first())
    return rows.select(
        F.col("nom_commune").alias(NAME), F.round("surface_mediane", 1).alias(AREA),
        F.col("nb_ventes").alias(SALES),
    )


def city_studio_rent(t: Tables) -> DataFrame:
    return rent_estimate(t, 1)


def city_two_room_rent(t: Tables) -> DataFrame:
    return rent_estimate(t, 2)


def city_crime(t: Tables) -> DataFrame:
    rate = F.round("taux_delinquance_pour_mille", 1).alias(CRIME)
    return in_scope(latest_crime(t), city(), by_code(rate))


def city_crime_by_category(t: Tables) -> DataFrame:
    rows = t.crime_detail.filter((F.col("annee") == t.periods.crime) & city())
    district = C.district_number("code_commune").alias("Arrondissement")
    rates = crime_by_category(rows, [district], CRIME)
    return rates.orderBy("Arrondissement", label(CRIME).desc_nulls_first())


def city_cycle_paths(t: Tables) -> DataFrame:
    return t.cycle.select(*by_code(F.col("km_par_km2").alias("Pistes cyclables (km/km²)")))


def city_transit(t: Tables) -> DataFrame:
    columns = by_code(F.col("stations_par_km2").alias("Stations par km²"))
    lines = F.col("nb_lignes_uniques").alias("Lignes desservies")
    return in_scope(t.transit, city(), [*columns, lines])


def city_senior(t: Tables) -> DataFrame:
    return in_scope(t.latest(), city(), by_code(percent("part_60_plus", SENIOR)), ["part_60_plus"])


def city_higher_education(t: Tables) -> DataFrame:
    return in_scope(with_diplomas(t), city(), by_code(F.col("part_etudes_sup").alias(HIGHER)))


def city_no_diploma(t: Tables) -> DataFrame:
    return in_scope(with_diplomas(t), city(), by_code(F.col("part_sans_diplome").alias(NO_DIPLOMA)))


def city_price_and_young(t: Tables) -> DataFrame:
    rows = t.latest().filter(city() & F.col("part_25_39").isNotNull())
    return rows.orderBy(F.col("prix_m2_median").asc_nulls_last()).select(
        F.col("nom_commune").alias(NAME), whole("prix_m2_median", PRICE_M2),
        percent("part_25_39", YOUNG),
    )


# --- inner ring, with or without the city -----------------------------------


def ring_price(t: Tables, include_city: bool = False) -> DataFrame:
    return in_scope(t.latest(), ring(include_city), by_code(whole("prix_m2_median", PRICE_M2)))


def ring_young(t: Tables, include_city: bool = False) -> DataFrame:
    return in_scope(t.latest(), ring(include_city), by_code(percent("part_25_39", YOUNG)))


def ring_price_series(t: Tables, include_city: bool = False, k: int = 10) -> DataFrame:
    """Price series of the ``k`` communes with most sales in the last year."""
    largest = top_k(t.latest().filter(ring(include_city)), "nb_ventes", k, ["code_commune"])
    rows = t.evolution.filter(C.in_inner_ring(include_city, department="code_departement"))
    return members_of(rows, largest, "code_commune").select(
        year_label(), F.col("nom_commune").alias(NAME), whole("prix_m2_median", PRICE_M2)
    ).orderBy(YEAR, NAME)


def ring_largest(t: Tables, include_city: bool = False, k: int = 20) -> DataFrame:
    largest = top_k(t.latest().filter(ring(include_city)), "nb_ventes", k, ["code_commune"])
    return largest.select(
        F.col("nom_commune").alias(NAME), F.col("code_departement").alias(DEPARTMENT),
        whole("prix_m2_median", PRICE_M2), F.col("nb_ventes").alias(SALES),
        percent("part_25_39", YOUNG), whole("niveau_vie_median", INCOME),
        F.round("ratio_achat_revenu_annuel", 1).alias(RATIO),
    )


def ring_rent(t: Tables, include_city: bool = False) -> DataFrame:
    rent = F.round("loyer_m2_median", 1).alias(RENT)
    return in_scope(t.latest(), ring(include_city), by_code(rent), ["loyer_m2_median"])


def ring_crime(t: Tables, include_city: bool = False) -> DataFrame:
    rate = F.round("taux_delinquance_pour_mille", 1).alias(CRIME)
    return in_scope(latest_crime(t), ring(include_city), by_code(rate))


def ring_crime_by_category(t: Tables, include_city: bool = False) -> DataFrame:
    rows = crime_in_scope(t, ring(include_city), t.periods.crime)
    return crime_by_category(rows, [], CRIME).orderBy(label(CRIME).desc_nulls_first(), CATEGORY)


def ring_transit(t: Tables, include_city: bool = False) -> DataFrame:
    scope = C.in_inner_ring(include_city, code="code_commune")
    return in_scope(t.transit, scope, by_code(F.col("stations_par_km2").alias("Stations par km²")))


def ring_senior(t: Tables, include_city: bool = False) -> DataFrame:
    return in_scope(
        t.latest(), ring(include_city), by_code(percent("part_60_plus", SENIOR)), ["part_60_plus"]
    )


def ring_higher_education(t: Tables, include_city: bool = False) -> DataFrame:
    column = F.col("part_etudes_sup").alias(HIGHER)
    return in_scope(with_diplomas(t), ring(include_city), by_code(column))


def ring_no_diploma(t: Tables, include_city: bool = False) -> DataFrame:
    column = F.col("part_sans_diplome").alias(NO_DIPLOMA)
    return in_scope(with_diplomas(t), ring(include_city), by_code(column))


def ring_price_and_young(t: Tables, include_city: bool = False) -> DataFrame:
    rows = t.latest().filter(ring(include_city) & F.col("part_25_39").isNotNull())
    return rows.orderBy(F.col("prix_m2_median").asc_nulls_last()).select(
        F.col("nom_commune").alias(NAME), F.col("code_departement").alias(DEPARTMENT),
        whole("prix_m2_median", PRICE_M2), percent("part_25_39", YOUNG),
    )


REGION_CARDS: Mapping[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (
        region_price_by_department, region_young_by_department, region_zone_table,
        region_price_series, region_sales_series, region_price_and_young, region_ratio_series,
        region_area_series, region_rent_by_department, region_rent_against_purchase,
        region_crime_by_department, region_crime_series, region_crime_by_category,
        region_category_series, region_senior_by_department, region_higher_education,
        region_no_diploma,
    )
}
CITY_CARDS: Mapping[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (
        city_price, city_young, city_price_series, city_detail, city_area, city_studio_rent,
        city_two_room_rent, city_crime, city_crime_by_category, city_cycle_paths, city_transit,
        city_senior, city_higher_education, city_no_diploma, city_price_and_young,
    )
}
RING_CARDS: Mapping[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        ring_price, ring_young, ring_price_series, ring_largest, ring_rent, ring_crime,
        ring_crime_by_category, ring_transit, ring_senior, ring_higher_education,
        ring_no_diploma, ring_price_and_young,
    )
}
