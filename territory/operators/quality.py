"""Data-quality checks. Each returns the violating rows; none means a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from territory import settings as S


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values with their number of rows; nulls are not compared."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list, with their number of rows; null passes."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def check_relationship(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key or key).alias(key)).dropDuplicates()
    return child.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")


def check_expression(df: DataFrame, violation: Column) -> DataFrame:
    """Rows for which the violation holds (null does not count)."""
    return df.filter(violation)


def check_freshness(
    df: DataFrame, ts: str, today: Column, warn_days: int, error_days: int
) -> DataFrame:
    """One row: last date, age in days and ``pass`` / ``warn`` / ``error``."""
    last = df.agg(F.to_date(F.max(ts)).alias("last_date"))
    age = F.datediff(today, F.col("last_date"))
    status = (
        F.when(age.isNull() | (age > error_days), "error").when(age > warn_days, "warn").otherwise("pass")
    )
    return last.select("last_date", age.alias("age_days"), status.alias("status"))


def check_file_age(spark: SparkSession, path: str, today: Column, warn_days: int, error_days: int) -> DataFrame:
    """``check_freshness`` of a source without a date: by when the newest of its files was written.

    Files are listed, not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return check_freshness(files.select(F.col("modificationTime").alias("written")), "written", today, warn_days, error_days)


def check_keys(
    tables: Mapping[str, tuple[DataFrame, str]], unique: Mapping[str, str], references: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Violations of rules on one kind of key, all rules by one exchange: table_name, n.

    ``tables`` names frames and their key columns; ``unique`` gives the table
    of each rule, ``references`` the child and the parent. A key's rows are
    counted per table, partially before the shuffle, so a hot key is one row per
    task. n is the number of repeated keys, or of child rows without a parent; null keys pass.
    """
    sides = {name: f"n{i}" for i, name in enumerate(tables)}
    tagged = [
        df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.lit(name).alias("side"))
        for name, (df, key) in tables.items()
    ]
    counts = reduce(DataFrame.unionByName, tagged).groupBy("key").agg(
        *[F.count_if(F.col("side") == name).alias(column) for name, column in sides.items()]
    )
    found = {rule: F.count_if(F.col(sides[name]) > 1) for rule, name in unique.items()}
    for rule, (child, parent) in references.items():
        orphans = F.when(F.col(sides[parent]) == 0, F.col(sides[child]))
        found[rule] = F.coalesce(F.sum(orphans), F.lit(0).cast("long"))
    totals = counts.agg(*[n.alias(rule) for rule, n in found.items()])
    return totals.select(F.inline(F.array(*[F.struct(F.lit(rule).alias("table_name"), F.col(rule).alias("n")) for rule in found])))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violating rows per row-level rule, all rules in one pass over ``df``."""
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("table_name"), F.col(name).alias("n")) for name in rules]
    )
    return counts.select(F.inline(pairs))


# --- rules on the models ----------------------------------------------------


def _outside(column: str, low: float, high: float) -> Column:
    return ~F.col(column).between(low, high)


def check_all(models: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of every rule on every model, one row per check.

    Row-level rules of a model share one pass; uniqueness and references share
    one exchange by commune code.
    """
    def missing(column: str) -> Column:
        return F.col(column).isNull()

    zone = ~F.col("zone_idf").isin(*S.ZONE_NAMES)
    ratio = (F.col("nb_ventes") >= 10) & _outside("ratio_achat_revenu_annuel", 1, 150)
    shares = _outside("part_60_plus", 0, 1) | (F.col("part_25_39") + F.col("part_60_plus") > 1.01)
    row_rules = {
        "sales": {"stage_sales_code_not_null": missing("code_commune")},
        "sale_stats": {"stage_sale_stats_code_not_null": missing("code_geo")},
        "communes": {"stage_communes_code_not_null": missing("code_commune")},
        "income_stage": {"stage_income_code_not_null": missing("code_commune")},
        "population": {"stage_population_code_not_null": missing("code_commune")},
        "population_age": {"stage_population_age_code_not_null": missing("code_commune")},
        "rents": {"stage_rents_code_not_null": missing("code_commune")},
        "crime_total": {"stage_crime_total_code_not_null": missing("code_commune")},
        "crime_detail": {"stage_crime_detail_code_not_null": missing("code_commune")},
        "communes_region": {
            "communes_code_not_null": missing("code_commune"),
            "communes_zone_not_null": missing("zone_idf"),
            "communes_zone_accepted": zone,
        },
        "prices": {
            "prices_code_not_null": missing("code_commune"),
            "prices_year_not_null": missing("annee"),
            "prices_sales_not_null": missing("nb_ventes"),
        },
        "income": {"income_code_not_null": missing("code_commune")},
        "age_structure": {
            "ages_code_not_null": missing("code_commune"),
            "ages_total_not_null": missing("population_totale"),
            "young_share_range": _outside("part_25_39", 0, 1),
            "age_shares_consistent": shares,
        },
        "accessibility": {
            "mart_code_not_null": missing("code_commune"),
            "mart_year_not_null": missing("annee"),
            "mart_zone_not_null": missing("zone_idf"),
            "mart_zone_accepted": zone,
            "mart_sales_not_null": missing("nb_ventes"),
            "mart_price_not_null": missing("prix_median"),
            "mart_price_m2_not_null": missing("prix_m2_median"),
            "crime_rate_positive": F.col("taux_delinquance_pour_mille") < 0,
            "rent_positive": F.col("loyer_m2_median") <= 0,
            "price_m2_positive": F.col("prix_m2_median") <= 0,
            "purchase_ratio_plausible": ratio,
            "median_area_plausible": _outside("surface_mediane", 5, 500),
        },
        "zones": {
            "zones_zone_not_null": missing("zone_idf"),
            "zones_zone_accepted": zone,
            "zones_year_not_null": missing("annee"),
        },
        "evolution": {
            "evolution_code_not_null": missing("code_commune"),
            "evolution_year_not_null": missing("annee"),
        },
    }
    names = ("communes", "communes_region", "prices", "income", "age_structure", "evolution")
    keyed = check_keys(
        {name: (models[name], "code_commune") for name in names},
        unique={
            "stage_communes_code_unique": "communes", "communes_code_unique": "communes_region",
            "income_code_unique": "income", "ages_code_unique": "age_structure",
        },
        references={
            "prices_code_known": ("prices", "communes_region"), "income_code_known": ("income", "communes_region"),
            "ages_code_known": ("age_structure", "communes_region"), "evolution_code_known": ("evolution", "communes_region"),
        },
    )
    results = [count_violations(models[name], rules) for name, rules in row_rules.items()]
    return reduce(DataFrame.unionByName, [*results, keyed])


class QualityError(Exception):
    """Rules that do not hold, with the number of violations of each."""

    def __init__(self, violations: Mapping[str, int]):
        super().__init__(", ".join(f"{rule}: {n}" for rule, n in sorted(violations.items())))
        self.violations = dict(violations)


def gate(counts: DataFrame) -> DataFrame:
    """The counts of ``check_all``, computed once; raises if any rule is violated."""
    rows = counts.collect()  # one row per rule
    violations = {r["table_name"]: r["n"] for r in rows if r["n"]}
    if violations:
        raise QualityError(violations)
    return counts.sparkSession.createDataFrame(rows, counts.schema)


#: Days without new data after which a source is reported, and after which it is refused.
FRESHNESS = {"sales": ("date_mutation", 90, 180)}
#: The same for sources whose rows carry no date, by the age of their file.
FILE_AGES = {table: (365, 730) for table in ("communes", "income", "population", "population_age", "rents", "crime", "diplomas")}


def check_sources(models: Mapping[str, DataFrame], today: Column, files: Mapping[str, str] | None = None) -> DataFrame:
    """Freshness of the sources: table_name, last_date, age_days, status.

    Sales carry a date of their own; of other sources, those in ``files`` (their paths) are as old as their newest file.
    """
    found = [
        check_freshness(models[name], column, today, warn, error).select(F.lit(name).alias("table_name"), "*")
        for name, (column, warn, error) in FRESHNESS.items()
        if name in models
    ]
    spark = next(iter(models.values())).sparkSession
    found += [
        check_file_age(spark, path, today, *FILE_AGES[name]).select(F.lit(name).alias("table_name"), "*")
        for name, path in (files or {}).items()
    ]
    return reduce(DataFrame.unionByName, found)
