"""From raw tables to result tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame

from territory import settings as S
from territory.operators.storage import materialise
from territory.plans import intermediate as I
from territory.plans import marts as M
from territory.plans import staging as T
from territory.sources.text import zone_seed


class Models(Mapping[str, DataFrame]):
    """Tables by name, each made when it is first asked for, together with those it reads."""

    def __init__(self, steps: Mapping[str, Callable[[Models], DataFrame]], shown: Sequence[str]):
        self._steps, self._shown = steps, shown
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._steps[name](self)
        return self._made[name]

    def __contains__(self, name: object) -> bool:
        return name in self._shown

    def __iter__(self) -> Iterator[str]:
        return iter(self._shown)

    def __len__(self) -> int:
        return len(self._shown)


def build_models(
    raw: Mapping[str, DataFrame],
    limits: S.Thresholds = S.Thresholds(),
    sales: DataFrame | None = None,
    store: bool = True,
    tension: bool = False,
) -> Mapping[str, DataFrame]:
    """All models by name, from the raw tables or an already loaded sales table.

    A model is made when it is asked for, so a reader of one pays for those that
    it is made from. With ``store`` the tables that several others read (communes,
    income, age structure, prices and the accessibility mart) are computed
    once into the checkpoint folder. Everything else stays lazy, but for the
    ``tension`` ranking, which is there if asked for: its score is stored
    between its two rankings.
    """
    def keep(df: DataFrame) -> DataFrame:
        return materialise(df) if store else df

    spark = raw["sales"].sparkSession
    steps: dict[str, Callable[[Models], DataFrame]] = {
        "sale_stats": lambda m: T.clean_sale_stats(raw["sale_stats"]),
        "income_stage": lambda m: T.clean_income(raw["income"]),
        "population": lambda m: T.clean_population(raw["population"]),
        "population_age": lambda m: T.clean_population_age(raw["population_age"]),
        "rents": lambda m: T.clean_rents(raw["rents"]),
        "crime_total": lambda m: T.crime_total(raw["crime"]),
        "sales": lambda m: T.clean_sales(raw["sales"]) if sales is None else sales,
        "communes": lambda m: T.clean_communes(raw["communes"], zone_seed(spark)),
        "communes_region": lambda m: keep(I.communes_region(m["communes"])),
        "income": lambda m: keep(
            I.income_by_commune(m["communes_region"], m["income_stage"], m["population"], m["rents"])
        ),
        "age_structure": lambda m: keep(I.age_structure(m["population_age"], m["communes_region"])),
        "prices": lambda m: keep(I.prices_by_commune_year(m["sales"], m["communes_region"], limits)),
        "accessibility": lambda m: keep(
            M.accessibility(m["prices"], m["income"], m["age_structure"], m["crime_total"], limits)
        ),
        "zones": lambda m: M.zone_summary(m["accessibility"]),
        "evolution": lambda m: M.price_evolution(m["prices"], m["communes_region"], limits),
        "tension": lambda m: M.tension(m["accessibility"]),
        "crime_detail": lambda m: T.crime_detail(raw["crime"]),
        "city_rooms": lambda m: M.city_prices_by_rooms(m["sales"], limits),
        "diplomas": lambda m: T.diplomas(raw["diplomas"]),
    }
    return Models(steps, [name for name in steps if tension or name != "tension"])
