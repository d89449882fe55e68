"""Indicators per commune."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from territory import settings as S
from territory.functions import clean as C
from territory.operators.aggregate import price_stats, shares_of_total
from territory.operators.dedup import keep_largest
from territory.operators.joins import enrich, restrict_to


def communes_region(communes: DataFrame) -> DataFrame:
    """Communes of the region."""
    return communes.filter("is_idf").select(
        "code_commune", "nom_commune", "code_departement", "code_region", "zone_idf",
        "type_commune",
    )


def plausible_sales(sales: DataFrame, region: DataFrame, limits: S.Thresholds) -> DataFrame:
    """One row per sale: its largest dwelling among the plausible lots."""
    lots = sales.filter(
        C.is_one_of("type_local", (S.FLAT, S.HOUSE))
        & C.strictly_between("valeur_fonciere", limits.price_min, limits.price_max)
        & C.strictly_between("surface_bati", limits.area_min, limits.area_max)
    ).select(
        "id_mutation", "code_commune", "annee", "type_local", "valeur_fonciere",
        "surface_bati", "numero_disposition",
    )
    scoped = restrict_to(lots, region, "code_commune")
    # Lots of equal area: the order of the remaining columns decides.
    ties = ("numero_disposition", "code_commune", "type_local", "annee", "valeur_fonciere")
    return keep_largest(scoped, "id_mutation", "surface_bati", ties)


def prices_by_commune_year(
    sales: DataFrame, region: DataFrame, limits: S.Thresholds = S.Thresholds()
) -> DataFrame:
    kept = plausible_sales(sales, region, limits).filter(F.col("annee") >= limits.year_min)
    kinds = {"nb_ventes_appartements": S.FLAT, "nb_ventes_maisons": S.HOUSE}
    keys = ["code_commune", "annee"]
    return price_stats(kept, keys, "valeur_fonciere", "surface_bati", "type_local", kinds)


def income_by_commune(
    region: DataFrame, income: DataFrame, population: DataFrame, rents: DataFrame
) -> DataFrame:
    """Income, population and rent of every commune of the region."""
    base = region.select("code_commune", "nom_commune", "code_departement", "zone_idf")
    tables = [
        income,
        population.select("code_commune", "population_2021"),
        rents.select("code_commune", "loyer_m2_median"),
    ]
    return enrich(base, tables, "code_commune").select(
        *base.columns,
        "niveau_vie_median", "niveau_vie_q1", "niveau_vie_q3", "niveau_vie_d1",
        "niveau_vie_d9", "indice_gini", "taux_pauvrete_60", "nb_menages_fiscaux",
        "population_2021", "loyer_m2_median",
        C.share("niveau_vie_d9", "niveau_vie_d1", digits=2).alias("ratio_interdecile_d9_d1"),
    )


def age_structure(population_age: DataFrame, region: DataFrame) -> DataFrame:
    """Population and shares of 25-39 and 60+ per commune of the region."""
    band = F.col("tranche_age_quinquennale")
    groups = {
        "25_39": band.isin("25-29", "30-34", "35-39"),
        "60_plus": (band >= "60-64") & (band <= "95+"),
    }
    scoped = restrict_to(population_age, region, "code_commune")
    return shares_of_total(scoped, "code_commune", "effectif", groups).select(
        "code_commune", F.col("total").alias("population_totale"),
        "pop_25_39", "pop_60_plus", "part_25_39", "part_60_plus",
    )
