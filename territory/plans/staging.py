"""Typed tables from the raw all-text ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from territory import settings as S
from territory.functions import clean as C
from territory.operators.aggregate import rate_per_thousand
from territory.operators.incremental import newer_than_stored, replace_by_key


def clean_sales(raw: DataFrame) -> DataFrame:
    """Sales only, with a commune: one row per lot."""
    texts = (
        "id_mutation", "numero_disposition", "nature_mutation", "code_commune", "nom_commune",
        "code_departement", "code_postal", "type_local",
    )
    numbers = {
        "surface_bati": "surface_reelle_bati",
        "surface_terrain": "surface_terrain",
        "valeur_fonciere": "valeur_fonciere",
        "latitude": "latitude",
        "longitude": "longitude",
    }
    kept = raw.filter((C.clean_string("nature_mutation") == S.SALE) & C.is_filled("code_commune"))
    day = C.parse_date("date_mutation")
    return kept.select(
        *[C.clean_string(c).alias(c) for c in texts],
        day.alias("date_mutation"),
        C.year_of(day).alias("annee"),
        C.blank_to_null_cast("nombre_pieces_principales", "int").alias("nb_pieces"),
        *[C.blank_to_null_cast(source, "double").alias(c) for c, source in numbers.items()],
    )


def load_sales(stored: DataFrame | None, raw: DataFrame) -> DataFrame:
    """New state of the sales table: rows dated after the stored maximum are
    cleaned and replace, id by id, what is stored."""
    if stored is None:
        return clean_sales(raw)
    late = newer_than_stored(stored, raw, C.parse_date("date_mutation"), "date_mutation")
    return replace_by_key(stored, clean_sales(late), "id_mutation")


def clean_sale_stats(raw: DataFrame) -> DataFrame:
    """Published sale statistics per area, whole period."""
    measures = []
    for kind in ("appartement", "maison", "apt_maison", "local"):
        measures += [
            C.blank_to_null_cast(f"nb_ventes_whole_{kind}", "int").alias(f"nb_ventes_{kind}"),
            C.blank_to_null_cast(f"moy_prix_m2_whole_{kind}", "double").alias(f"prix_m2_moyen_{kind}"),
            C.blank_to_null_cast(f"med_prix_m2_whole_{kind}", "double").alias(f"prix_m2_median_{kind}"),
        ]
    texts = ("code_geo", "libelle_geo", "code_parent", "echelle_geo")
    return raw.filter(F.col("code_geo").isNotNull()).select(
        *[C.clean_string(c).alias(c) for c in texts], *measures
    )


def clean_communes(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """Communes and city districts, with zone and region flag."""
    columns = {
        "code_commune": "COM", "nom_commune": "LIBELLE", "code_departement": "DEP",
        "code_region": "REG", "type_commune": "TYPECOM", "code_commune_parent": "COMPARENT",
    }
    communes = raw.select(*[C.clean_string(source).alias(c) for c, source in columns.items()])
    communes = communes.filter(C.is_one_of("type_commune", S.COMMUNE_TYPES))
    # The zone seed has one row per department of the region.
    zoned = communes.join(F.broadcast(zones), "code_departement", "left")
    return zoned.select(*columns, "zone_idf", C.in_region("code_region").alias("is_idf"))


def clean_income(raw: DataFrame) -> DataFrame:
    """Income per commune. The poverty column is a proxy: the share of
    households that pay no income tax."""
    numbers = {
        "niveau_vie_median": "Q221", "niveau_vie_q1": "Q121", "niveau_vie_q3": "Q321",
        "niveau_vie_d1": "D121", "niveau_vie_d9": "D921", "indice_gini": "GI21",
    }
    return raw.filter(F.col("CODGEO").isNotNull()).select(
        C.clean_string("CODGEO").alias("code_commune"),
        *[C.clean_numeric(source).alias(c) for c, source in numbers.items()],
        C.complement_rate(C.clean_numeric("PMIMP21")).alias("taux_pauvrete_60"),
        C.clean_numeric("NBMEN21").alias("nb_menages_fiscaux"),
    )


def clean_population_age(raw: DataFrame) -> DataFrame:
    """Population by sex and age; the all-ages rows, and rows without an age,
    are left out."""
    kept = raw.filter(F.col("CODGEO").isNotNull() & F.col("NB").isNotNull())
    typed = kept.select(
        C.clean_string("CODGEO").alias("code_commune"),
        C.clean_string("SEXE").alias("sexe"),
        C.clean_string("AGED100").alias("age_revolu"),
        C.blank_to_null_cast("NB", "double").alias("effectif"),
    ).filter(F.col("age_revolu") != S.ALL_AGES)
    age = C.blank_to_null_cast("age_revolu", "int")
    return typed.withColumn("age_int", age).withColumn(
        "tranche_age_quinquennale", C.age_band("age_int")
    )


def clean_population(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("CODGEO").isNotNull()).select(
        C.clean_string("CODGEO").alias("code_commune"),
        C.clean_string("LIBGEO").alias("nom_commune"),
        C.blank_to_null_cast("PMUN2021", "double").alias("population_2021"),
        C.blank_to_null_cast("PMUN2015", "double").alias("population_2015"),
    )


def _published_crime(raw: DataFrame) -> DataFrame:
    kept = raw.filter(
        C.is_filled("CODGEO_2025") & (C.clean_string("est_diffuse") == S.PUBLISHED)
    )
    return kept.select(
        C.clean_string("CODGEO_2025").alias("code_commune"),
        C.blank_to_null_cast("annee", "int").alias("annee"),
        C.clean_string("indicateur").alias("type_delit"),
        C.clean_numeric("nombre").alias("nb_faits"),
        C.clean_numeric("taux_pour_mille").alias("taux_pour_mille"),
        C.clean_numeric("insee_pop").alias("population"),
    )


def crime_detail(raw: DataFrame) -> DataFrame:
    """Published facts per commune, year and offence."""
    return _published_crime(raw).filter(F.col("nb_faits").isNotNull())


def crime_total(raw: DataFrame) -> DataFrame:
    """All published offences per commune and year, as a rate per thousand."""
    rates = rate_per_thousand(
        _published_crime(raw), ["code_commune", "annee"], "nb_faits", "population"
    )
    return rates.select(
        "code_commune", "annee",
        F.col("facts").alias("nb_faits_total"), "population",
        F.col("rate").alias("taux_delinquance_pour_mille"),
    )


def clean_rents(raw: DataFrame) -> DataFrame:
    """Predicted rent per square metre, with its interval."""
    return raw.filter(C.is_filled("INSEE_C")).select(
        C.clean_string("INSEE_C").alias("code_commune"),
        C.clean_string("LIBGEO").alias("nom_commune"),
        C.clean_string("DEP").alias("code_departement"),
        C.clean_numeric("loypredm2").alias("loyer_m2_median"),
        C.clean_numeric("`lwr.IPm2`").alias("loyer_m2_borne_basse"),
        C.clean_numeric("`upr.IPm2`").alias("loyer_m2_borne_haute"),
        C.clean_string("TYPPRED").alias("type_prediction"),
        C.blank_to_null_cast("nbobs_com", "int").alias("nb_observations_commune"),
    )


def diplomas(raw: DataFrame) -> DataFrame:
    """Education shares (%) of people aged 15 and over who left school."""
    total = F.col("P21_NSCOL15P").cast("double")
    years_2, years_34, years_5 = (
        F.col(f"P21_NSCOL15P_SUP{level}").cast("double") for level in ("2", "34", "5")
    )
    without = F.col("P21_NSCOL15P_DIPLMIN").cast("double")
    return raw.filter(total > 0).select(
        F.col("CODGEO").alias("code_commune"),
        F.round(total).alias("pop_15p_non_scol"),
        C.share(without, total, 100, 1).alias("part_sans_diplome"),
        C.share(years_2 + years_34 + years_5, total, 100, 1).alias("part_etudes_sup"),
        C.share(years_5, total, 100, 1).alias("part_bac5_plus"),
    )
