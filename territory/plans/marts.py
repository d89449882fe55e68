"""Result tables per commune and year, zone and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from territory import settings as S
from territory.functions import clean as C
from territory.operators.aggregate import weighted_rollup
from territory.operators.joins import enrich
from territory.operators.order_stats import exact_medians
from territory.operators.trend import composite_index, rank_by, with_previous
from territory.schemas import in_contract


def accessibility(
    prices: DataFrame,
    income: DataFrame,
    ages: DataFrame,
    crime: DataFrame,
    limits: S.Thresholds = S.Thresholds(),
) -> DataFrame:
    """Prices against income, age, rent and crime, per commune and year.

    The income table has one row per commune of the region. Communes without
    a known median income take no part, so the income join is an inner one.
    """
    known = income.filter(F.col("niveau_vie_median").isNotNull())
    facts = prices.filter(F.col("nb_ventes") >= limits.sales_min)
    base = facts.join(known, "code_commune")
    base = enrich(base, [ages.withColumnRenamed("population_totale", "population_rp")], "code_commune")
    totals = crime.select(
        "code_commune", "annee", "taux_delinquance_pour_mille",
        F.col("nb_faits_total").alias("nb_faits_delinquance"),
    )
    base = enrich(base, [totals], ["code_commune", "annee"])
    ratios = {
        "ratio_prix_m2_revenu_mensuel": ("prix_m2_median", F.col("niveau_vie_median") / 12),
        "ratio_achat_revenu_annuel": ("prix_median", F.col("niveau_vie_median")),
        "ratio_achat_revenu_q1": ("prix_median", F.col("niveau_vie_q1")),
        "ratio_achat_loyer_annuel": ("prix_m2_median", F.col("loyer_m2_median") * 12),
    }
    return in_contract(
        base.withColumns({c: C.share(n, d, digits=1) for c, (n, d) in ratios.items()}),
        "accessibility",
    )


def zone_summary(mart: DataFrame) -> DataFrame:
    """Weighted indicators per zone and year."""
    sales, people = "nb_ventes", "population_2021"
    specs = {
        "prix_m2_median_pondere": ("prix_m2_median", sales, 0),
        "prix_median_pondere": ("prix_median", sales, 0),
        "niveau_vie_median_pondere": ("niveau_vie_median", people, 0),
        "part_25_39_ponderee": ("part_25_39", people, 4),
        "ratio_achat_revenu_pondere": ("ratio_achat_revenu_annuel", sales, 1),
        "ratio_m2_revenu_pondere": ("ratio_prix_m2_revenu_mensuel", sales, 1),
    }
    rollup = weighted_rollup(
        mart, ["zone_idf", "annee"], specs,
        C.total(people).alias("population_totale"),
        F.count(F.lit(1)).alias("nb_communes"),
        F.sum(sales).alias("nb_ventes_total"),
    )
    return in_contract(rollup, "zones").orderBy("annee", "zone_idf")


def price_evolution(
    prices: DataFrame, region: DataFrame, limits: S.Thresholds = S.Thresholds()
) -> DataFrame:
    """Change against the previous year kept for the commune."""
    names = region.select("code_commune", "nom_commune", "code_departement", "zone_idf")
    kept = prices.filter(F.col("nb_ventes") >= limits.sales_min).join(names, "code_commune")
    previous = {
        "prix_m2_median": "prix_m2_median_annee_prec",
        "prix_median": "prix_median_annee_prec",
    }
    series = with_previous(kept, "code_commune", "annee", previous)
    return in_contract(
        series.withColumns(
            {
                "variation_prix_m2_pct": C.pct_change("prix_m2_median", "prix_m2_median_annee_prec"),
                "variation_prix_median_pct": C.pct_change("prix_median", "prix_median_annee_prec"),
            }
        ),
        "evolution",
    )


def tension(mart: DataFrame) -> DataFrame:
    """Tension index (0-100) per commune within a year, and its rank.

    Percentiles are taken within a year, and rows lacking a component are left
    out; the definition of the index leaves both open.
    """
    effort, m2, young, poor = S.TENSION_WEIGHTS
    components = {
        "effort": (F.col("ratio_achat_revenu_annuel"), effort),
        "m2": (F.col("ratio_prix_m2_revenu_mensuel"), m2),
        "few_young": (-F.col("part_25_39"), young),
        "poverty": (F.col("taux_pauvrete_60"), poor),
    }
    row = ["code_commune", "nom_commune", "code_departement", "zone_idf", "annee"]
    index = composite_index(mart, row, ["annee"], components, "indice_tension")
    ranked = rank_by(index, ["annee"], "indice_tension", "rang")
    return ranked.select(*row, "indice_tension", "rang")


def city_prices_by_rooms(
    sales: DataFrame, limits: S.Thresholds = S.Thresholds(), rooms: tuple[int, ...] = (1, 2, 3)
) -> DataFrame:
    """City flats of one to three rooms: every lot counts, small groups go."""
    lots = sales.filter(
        (F.col("type_local") == S.FLAT)
        & C.is_one_of("nb_pieces", rooms)
        & (F.col("valeur_fonciere") > limits.rooms_price_min)
        & C.in_city("code_commune")
    )
    keys = ["code_commune", "nom_commune", "nb_pieces", "annee"]
    price, area = F.col("valeur_fonciere"), F.col("surface_bati")
    measures = {"rows": F.lit(1.0), "price": price, "m2": C.safe_divide(price, area), "area": area}
    stats = exact_medians(lots, keys, measures, sums=False).filter(F.col("rows_count") >= limits.sales_min)
    return stats.select(
        *keys,
        F.col("rows_count").alias("nb_ventes"),
        F.round("price_median").alias("prix_median"),
        F.round("m2_median").alias("prix_m2_median"),
        F.round("area_median", 1).alias("surface_mediane"),
    )
