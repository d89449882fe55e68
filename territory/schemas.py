"""Columns of the raw tables and contracts of the results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Raw tables: the columns the models read; every one is text.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "sales": (
        "id_mutation", "numero_disposition", "date_mutation", "nature_mutation",
        "code_commune", "nom_commune", "code_departement", "code_postal", "type_local",
        "nombre_pieces_principales", "surface_reelle_bati", "surface_terrain",
        "valeur_fonciere", "latitude", "longitude",
    ),
    "sale_stats": (
        "code_geo", "libelle_geo", "code_parent", "echelle_geo",
        *(
            f"{measure}_whole_{kind}"
            for kind in ("appartement", "maison", "apt_maison", "local")
            for measure in ("nb_ventes", "moy_prix_m2", "med_prix_m2")
        ),
    ),
    "communes": ("COM", "LIBELLE", "DEP", "REG", "TYPECOM", "COMPARENT"),
    "income": ("CODGEO", "Q121", "Q221", "Q321", "D121", "D921", "GI21", "PMIMP21", "NBMEN21"),
    "population": ("CODGEO", "LIBGEO", "PMUN2021", "PMUN2015"),
    "population_age": ("CODGEO", "SEXE", "AGED100", "NB"),
    "rents": (
        "INSEE_C", "LIBGEO", "DEP", "loypredm2", "lwr.IPm2", "upr.IPm2", "TYPPRED", "nbobs_com",
    ),
    "crime": (
        "CODGEO_2025", "annee", "indicateur", "est_diffuse", "nombre", "taux_pour_mille",
        "insee_pop",
    ),
    "diplomas": (
        "CODGEO", "P21_NSCOL15P", "P21_NSCOL15P_DIPLMIN", "P21_NSCOL15P_SUP2",
        "P21_NSCOL15P_SUP34", "P21_NSCOL15P_SUP5",
    ),
}

# How each raw text table is written: separator (None: told by its first lines), encoding, ragged rows.
RAW_FORMATS: dict[str, dict] = {
    "sales": {"sep": None},
    "sale_stats": {"sep": None},
    "communes": {"sep": None},
    "income": {"sep": ";"},
    "population": {"sep": ","},
    "population_age": {"sep": ";"},
    "rents": {"sep": ";", "encoding": "ISO-8859-1"},
    "crime": {"sep": ";"},
    "diplomas": {"sep": ";"},
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])


ZONE_SCHEMA = T.StructType(
    [T.StructField("code_departement", T.StringType()), T.StructField("zone_idf", T.StringType())]
)

STATION_SCHEMA = T.StructType(
    [
        T.StructField("stationCode", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("capacity", T.IntegerType()),
    ]
)
CYCLE_PATH_SCHEMA = T.StructType(
    [T.StructField("arrondissement", T.StringType()), T.StructField("longueur_m", T.DoubleType())]
)
COUNTER_SCHEMA = T.StructType(
    [
        T.StructField("id_compteur", T.StringType()),
        T.StructField(
            "coordinates",
            T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]),
        ),
    ]
)
TRAFFIC_SCHEMA = T.StructType(
    [
        T.StructField("id_compteur", T.StringType()),
        T.StructField("nom_compteur", T.StringType()),
        T.StructField("total_passages", T.LongType()),
    ]
)
STOP_SCHEMA = T.StructType(
    [
        T.StructField("stop_name", T.StringType()),
        T.StructField("stop_lat", T.StringType()),
        T.StructField("stop_lon", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("shortname", T.StringType()),
    ]
)

# Result contracts: column names in order.
CONTRACTS: dict[str, tuple[str, ...]] = {
    "accessibility": (
        "code_commune", "nom_commune", "code_departement", "zone_idf", "annee",
        "population_2021", "population_rp", "pop_25_39", "part_25_39", "part_60_plus",
        "niveau_vie_median", "niveau_vie_q1", "niveau_vie_q3", "taux_pauvrete_60",
        "indice_gini", "ratio_interdecile_d9_d1", "nb_menages_fiscaux", "loyer_m2_median",
        "nb_ventes", "nb_ventes_appartements", "nb_ventes_maisons", "prix_median",
        "prix_moyen", "prix_m2_median", "prix_m2_moyen", "surface_mediane",
        "taux_delinquance_pour_mille", "nb_faits_delinquance",
        "ratio_prix_m2_revenu_mensuel", "ratio_achat_revenu_annuel",
        "ratio_achat_revenu_q1", "ratio_achat_loyer_annuel",
    ),
    "zones": (
        "zone_idf", "annee", "population_totale", "nb_communes", "nb_ventes_total",
        "prix_m2_median_pondere", "prix_median_pondere", "niveau_vie_median_pondere",
        "part_25_39_ponderee", "ratio_achat_revenu_pondere", "ratio_m2_revenu_pondere",
    ),
    "evolution": (
        "code_commune", "nom_commune", "code_departement", "zone_idf", "annee", "nb_ventes",
        "prix_m2_median", "prix_median", "prix_m2_median_annee_prec", "prix_median_annee_prec",
        "variation_prix_m2_pct", "variation_prix_median_pct",
    ),
}


def in_contract(df: DataFrame, name: str) -> DataFrame:
    """Exactly the contract's columns, in its order; a missing one fails."""
    return df.select(*CONTRACTS[name])
