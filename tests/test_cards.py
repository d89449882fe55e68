"""Cards make the tables they read, no others."""

from contract import queries as Q

SF = "/root/testdata/sf0.001"


def test_a_card_makes_its_own_tables_only(spark, monkeypatch):
    made = []
    real = Q.build_models
    monkeypatch.setattr(Q, "_models", {})
    monkeypatch.setattr(Q, "_tables", {})
    monkeypatch.setattr("territory.plans.build.materialise", lambda df: made.append(df) or df)
    monkeypatch.setattr(Q, "build_models", lambda *args, **options: real(*args, **options))
    cards = Q.all_queries()
    cards["serving_city_transit"](spark, SF).columns
    cards["serving_city_crime_by_category"](spark, SF).columns
    assert not made
    cards["model_age_structure"](spark, SF).columns
    assert len(made) == 2
    cards["serving_region_price_series"](spark, SF).columns
    assert len(made) == 5
