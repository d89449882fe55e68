"""Models on hand-made raw tables."""

import datetime

import pytest

from territory import schemas
from territory import settings as S
from territory.operators import quality
from territory.plans import intermediate as I
from territory.plans import marts as M
from territory.plans import serving
from territory.plans import staging as T
from territory.plans.build import build_models
from territory.sources.text import zone_seed


def raw(spark, table, *records):
    columns = schemas.RAW_COLUMNS[table]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in records], schemas.raw_schema(table))


def sale(key, day="2024-01-15", **changes):
    record = {
        "id_mutation": key, "numero_disposition": "1", "date_mutation": day, "nature_mutation": "Vente",
        "code_commune": "75101", "nom_commune": "Paris 1er", "code_departement": "75",
        "code_postal": "75001", "type_local": "Appartement", "nombre_pieces_principales": "3",
        "surface_reelle_bati": "65", "surface_terrain": "", "valeur_fonciere": "450000",
        "latitude": "48.86", "longitude": "2.34",
    }
    return record | changes


def test_only_sales_with_a_commune(spark):
    df = T.clean_sales(raw(
        spark, "sales", sale("M1"), sale("M2", nature_mutation="Echange"),
        sale("M3", code_commune="", type_local="Maison", valeur_fonciere="200000"),
    ))
    (row,) = df.collect()
    assert (row["id_mutation"], row["nature_mutation"], row["code_commune"]) == ("M1", "Vente", "75101")
    assert (row["valeur_fonciere"], row["surface_bati"], row["annee"]) == (450000.0, 65.0, 2024)
    assert row["surface_terrain"] is None and row["nb_pieces"] == 3


def test_incremental_sales(spark):
    stored = T.load_sales(None, raw(spark, "sales", sale("M1"), sale("M2", "2024-01-31")))
    later = raw(
        spark, "sales", sale("M1", "2024-01-31"), sale("M2", "2024-02-01", valeur_fonciere="1"),
        sale("M2", "2024-02-01", valeur_fonciere="2"),
    )
    got = T.load_sales(stored, later)
    assert sorted((r["id_mutation"], r["date_mutation"].day, r["valeur_fonciere"]) for r in got.collect()) == [
        ("M1", 15, 450000.0), ("M2", 1, 1.0), ("M2", 1, 2.0)
    ]


def communes(spark):
    return raw(
        spark, "communes",
        {"COM": "75101", "LIBELLE": " Paris 1er ", "DEP": "75", "REG": "11", "TYPECOM": "ARM", "COMPARENT": "75056"},
        {"COM": "75056", "LIBELLE": "Paris", "DEP": "75", "REG": "11", "TYPECOM": "COM"},
        {"COM": "92001", "LIBELLE": "B", "DEP": "92", "REG": "11", "TYPECOM": "COM"},
        {"COM": "60001", "LIBELLE": "C", "DEP": "60", "REG": "32", "TYPECOM": "COM"},
        {"COM": "92001", "LIBELLE": "B", "DEP": "92", "REG": "11", "TYPECOM": "COMD"},
        {"COM": "99001", "LIBELLE": "D", "DEP": None, "REG": None, "TYPECOM": "COM"},
    )


def test_commune_dimension(spark):
    df = T.clean_communes(communes(spark), zone_seed(spark))
    got = {r["code_commune"]: (r["nom_commune"], r["zone_idf"], r["is_idf"]) for r in df.collect()}
    assert got == {
        "75101": ("Paris 1er", "Paris", True), "75056": ("Paris", "Paris", True),
        "92001": ("B", "Petite couronne", True), "60001": ("C", None, False), "99001": ("D", None, None),
    }
    assert I.communes_region(df).count() == 3


def test_lots_of_a_sale_count_once_after_the_outlier_filter(spark):
    region = I.communes_region(T.clean_communes(communes(spark), zone_seed(spark)))
    sales = T.clean_sales(raw(
        spark, "sales",
        sale("M1", surface_reelle_bati="20"), sale("M1", surface_reelle_bati="45"),
        sale("M1", surface_reelle_bati="9000"), sale("M1", surface_reelle_bati=""),
        sale("M2", type_local="Dépendance"), sale("M3", valeur_fonciere="1000"),
        sale("M4", code_commune="60001"), sale("M5", day="2017-05-01"),
    ))
    (row,) = I.prices_by_commune_year(sales, region).collect()
    assert (row["nb_ventes"], row["surface_mediane"], row["prix_m2_median"]) == (1, 45.0, 10000.0)


def test_ages(spark):
    def age(a, n="10"):
        return {"CODGEO": "92001", "SEXE": "1", "AGED100": a, "NB": n}

    df = T.clean_population_age(raw(
        spark, "population_age", age("000"), age("004"), age("005"), age("094"), age("095"), age("ENS"),
        age(None), age("030", None), age("027", ""),
    ))
    assert [r["tranche_age_quinquennale"] for r in df.orderBy("age_revolu").collect()] == [
        "00-04", "00-04", "05-09", "25-29", "90-94", "95+"
    ]
    region = I.communes_region(T.clean_communes(communes(spark), zone_seed(spark)))
    (r,) = I.age_structure(df, region).collect()
    assert (r["population_totale"], r["pop_25_39"], r["pop_60_plus"], r["part_60_plus"]) == (50.0, 0.0, 20.0, 0.4)


def test_income_markers(spark):
    df = T.clean_income(raw(spark, "income", {"CODGEO": " 92001 ", "Q221": "25 000,5".replace(" ", ""), "Q121": "s", "PMIMP21": "62,3"}))
    r = df.first()
    assert (r["code_commune"], r["niveau_vie_median"], r["niveau_vie_q1"], r["taux_pauvrete_60"]) == ("92001", 25000.5, None, 37.7)


@pytest.fixture(scope="module")
def small(spark):
    """Two communes, two years, five or more sales each."""
    sales = [
        sale(f"{code}-{year}-{i}", f"{year}-03-0{1 + i}", code_commune=code, code_departement=code[:2],
             nom_commune=code, valeur_fonciere=str(100000 * (1 + i) * (2 if code == "75101" else 1) + (year - 2024) * 30000),
             surface_reelle_bati="50", nombre_pieces_principales="1", type_local="Maison" if i == 4 else "Appartement")
        for code in ("75101", "92001") for year in (2024, 2025) for i in range(6)
    ]
    inputs = {
        "sales": raw(spark, "sales", *sales),
        "communes": communes(spark),
        "income": raw(spark, "income", *[
            {"CODGEO": c, "Q221": q, "Q121": "15000", "Q321": "40000", "D121": "10000", "D921": "55000", "GI21": "0,3", "PMIMP21": "60", "NBMEN21": "10"}
            for c, q in (("75101", "30000"), ("92001", "25000"), ("75056", "nd"))
        ]),
        "population": raw(spark, "population", {"CODGEO": "75101", "PMUN2021": "1000"}, {"CODGEO": "92001", "PMUN2021": "3000"}),
        "population_age": raw(spark, "population_age", *[
            {"CODGEO": c, "SEXE": "1", "AGED100": a, "NB": n}
            for c, a, n in (("75101", "030", "30"), ("75101", "065", "70"), ("92001", "030", "50"), ("92001", "065", "50"))
        ]),
        "sale_stats": spark.createDataFrame([], schemas.raw_schema("sale_stats")),
        "rents": raw(spark, "rents", {"INSEE_C": "75101", "loypredm2": "30,5"}),
        "crime": raw(spark, "crime", *[
            {"CODGEO_2025": c, "annee": "2024", "indicateur": o, "est_diffuse": d, "nombre": n, "insee_pop": "1000"}
            for c, o, d, n in (
                ("75101", "Vols avec armes", "diff", "10"), ("75101", "Violences sexuelles", "diff", "5"),
                ("75101", "Vols avec armes", "ndiff", "99"), ("92001", "Usage de stupéfiants", "diff", "2"),
            )
        ]),
        "diplomas": raw(spark, "diplomas", {
            "CODGEO": "75101", "P21_NSCOL15P": "200.4", "P21_NSCOL15P_DIPLMIN": "20.04", "P21_NSCOL15P_SUP2": "10.02",
            "P21_NSCOL15P_SUP34": "30.06", "P21_NSCOL15P_SUP5": "60.12",
        }, {"CODGEO": "92001", "P21_NSCOL15P": "0"}),
    }
    return build_models(inputs, tension=True)


def test_contracts(small):
    for name, columns in schemas.CONTRACTS.items():
        assert tuple(small[name].columns) == columns


def test_accessibility(small):
    got = {(r["code_commune"], r["annee"]): r for r in small["accessibility"].collect()}
    assert set(got) == {(c, y) for c in ("75101", "92001") for y in (2024, 2025)}
    r = got["75101", 2024]
    assert (r["nb_ventes"], r["nb_ventes_maisons"], r["prix_median"], r["prix_m2_median"]) == (6, 1, 700000.0, 14000.0)
    assert (r["ratio_achat_revenu_annuel"], r["ratio_prix_m2_revenu_mensuel"]) == (23.3, 5.6)
    assert (r["ratio_achat_loyer_annuel"], r["ratio_interdecile_d9_d1"]) == (38.3, 5.5)
    assert (r["taux_delinquance_pour_mille"], r["nb_faits_delinquance"]) == (15.0, 15.0)
    assert got["75101", 2025]["taux_delinquance_pour_mille"] is None
    assert got["92001", 2024]["ratio_achat_loyer_annuel"] is None


def test_evolution_and_zones(small):
    evolution = {(r["code_commune"], r["annee"]): r for r in small["evolution"].collect()}
    assert evolution["75101", 2024]["prix_median_annee_prec"] is None
    assert evolution["75101", 2025]["variation_prix_median_pct"] == 4.3
    zones = {(r["zone_idf"], r["annee"]): r for r in small["zones"].collect()}
    assert zones["Paris", 2024]["population_totale"] == 1000.0
    assert zones["Petite couronne", 2024]["part_25_39_ponderee"] == 0.5


def test_tension_and_diplomas(small):
    got = {(r["code_commune"], r["annee"]): (r["indice_tension"], r["rang"]) for r in small["tension"].collect()}
    assert got["75101", 2024] == (100.0, 1) and got["92001", 2024] == (0.0, 2)
    (r,) = small["diplomas"].collect()
    assert (r["pop_15p_non_scol"], r["part_sans_diplome"], r["part_etudes_sup"], r["part_bac5_plus"]) == (200.0, 10.0, 50.0, 30.0)


def test_quality_rules_pass(small):
    violations = {r["table_name"]: r["n"] for r in quality.check_all(small).collect() if r["n"]}
    assert violations == {}


def test_cards(small):
    tables = serving.Tables(
        accessibility=small["accessibility"], zones=small["zones"], evolution=small["evolution"],
        crime_detail=small["crime_detail"], city_rooms=small["city_rooms"], diplomas=small["diplomas"],
    )
    assert len(serving.REGION_CARDS) + len(serving.CITY_CARDS) + len(serving.RING_CARDS) == 44
    prices = serving.region_price_by_department(tables).collect()
    assert [tuple(r) for r in prices] == [("75", 14600.0, 6), ("92", 7600.0, 6)]
    assert [tuple(r) for r in serving.city_studio_rent(tables).collect()] == [("75101", 1525.0)]
    categories = [tuple(r) for r in serving.region_crime_by_category(tables).collect()]
    assert categories == [("Vols", 10.0), ("Violences", 5.0), ("Stupéfiants", 2.0)]
    assert serving.ring_price(tables).count() == 1
    assert serving.ring_price(tables, include_city=True).count() == 2
    assert [r[0] for r in serving.ring_price_series(tables, include_city=True, k=1).select("Commune").distinct().collect()] == ["Paris 1er"]


def test_limits_are_parameters(spark):
    region = I.communes_region(T.clean_communes(communes(spark), zone_seed(spark)))
    sales = T.clean_sales(raw(spark, "sales", sale("M1", day="2017-05-01")))
    assert I.prices_by_commune_year(sales, region, S.Thresholds(year_min=2017)).count() == 1
    assert M.city_prices_by_rooms(sales, S.Thresholds(sales_min=1)).count() == 1
    assert datetime.date(2017, 5, 1) == sales.first()["date_mutation"]
