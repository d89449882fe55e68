"""Grouped indicators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from territory.functions import clean as C
from territory.operators.order_stats import exact_medians


def price_stats(
    df: DataFrame,
    keys: Sequence[str],
    price: str,
    area: str,
    kind: str,
    kinds: Mapping[str, str],
) -> DataFrame:
    """Sales count, counts by dwelling kind, and median and mean of price,
    price per square metre and area. ``kinds`` maps an output column to the
    kind counted in it."""
    measures = {
        "prix": ("prix_median", "prix_moyen", F.col(price)),
        "m2": ("prix_m2_median", "prix_m2_moyen", C.safe_divide(price, area)),
        "surface": ("surface_mediane", "surface_moyenne", F.col(area)),
    }
    medians = exact_medians(df, keys, {m: column for m, (_, _, column) in measures.items()}, sums=False)
    plain = df.groupBy(F.struct(*keys).alias("key")).agg(
        F.count(F.lit(1)).alias("nb_ventes"),
        *[F.count_if(F.col(kind) == label).alias(column) for column, label in kinds.items()],
        *[F.avg(column.cast("double")).alias(mean) for _, mean, column in measures.values()],
    )
    # The struct is never null, so groups whose key columns are null meet.
    middle = medians.select(
        F.struct(*keys).alias("key"), *[F.col(f"{m}_median").alias(median) for m, (median, _, _) in measures.items()]
    )
    return plain.join(middle, "key", "left").select(
        "key.*", "nb_ventes", *kinds, *[name for median, mean, _ in measures.values() for name in (median, mean)]
    )


def sum_where(amount: str, member: Column) -> Column:
    """Conditional sum; 0 where nothing matches."""
    return C.total(F.when(member, F.col(amount)).otherwise(F.lit(0.0)))


def shares_of_total(
    df: DataFrame, key: str, amount: str, groups: Mapping[str, Column]
) -> DataFrame:
    """Total, group sums (``pop_<g>``) and group shares (``part_<g>``) per key."""
    sums = df.groupBy(key).agg(
        C.total(amount).alias("total"),
        *[sum_where(amount, member).alias(f"pop_{g}") for g, member in groups.items()],
    )
    return sums.select(
        "*", *[C.share(f"pop_{g}", "total").alias(f"part_{g}") for g in groups]
    )


def detail_with_totals(df: DataFrame, key: str, band: str, amount: str) -> DataFrame:
    """Band sums per key next to the key's total. The window sees one row per
    key and band, whatever the number of input rows."""
    bands = df.groupBy(key, band).agg(C.total(amount).alias(amount))
    return bands.withColumn("total", C.total(amount, Window.partitionBy(key)))


def rate_per_thousand(
    df: DataFrame, keys: Sequence[str], facts: str, population: str
) -> DataFrame:
    """Facts per thousand inhabitants; the population repeats on each row of
    a key, hence its maximum."""
    sums = df.groupBy(*keys).agg(
        C.total(facts).alias("facts"), F.max(population).alias("population")
    )
    return sums.withColumn("rate", C.share("facts", "population", 1000, 1))


def rate_on_sums(facts: str, population: str, digits: int = 1) -> Column:
    """Aggregate ``sum(facts) / sum(population) * 1000``."""
    ratio = C.safe_divide(C.total(facts), C.total(population))
    return F.round(ratio * 1000, digits)


def weighted_rollup(
    df: DataFrame,
    keys: Sequence[str],
    specs: Mapping[str, tuple[str, str, int]],
    *more: Column,
) -> DataFrame:
    """Weighted means per key; ``specs`` maps a name to (value, weight, digits)."""
    means = [
        F.round(C.weighted_mean(value, weight), digits).alias(name)
        for name, (value, weight, digits) in specs.items()
    ]
    return df.groupBy(*keys).agg(*more, *means)


def sum_by(df: DataFrame, keys: Sequence[str], amount: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(C.total(amount).alias(name))


def sum_in_period(
    df: DataFrame, keys: Sequence[str], day: str, start: str, end: str, amount: str, name: str
) -> DataFrame:
    """Sum over the half-open period [start, end)."""
    inside = (F.col(day) >= F.lit(start).cast("date")) & (F.col(day) < F.lit(end).cast("date"))
    return sum_by(df.filter(inside), keys, amount, name)


def distinct_by(df: DataFrame, keys: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Exact distinct counts; ``names`` maps an output name to a column."""
    return df.groupBy(*keys).agg(
        *[F.countDistinct(column).alias(name) for name, column in names.items()]
    )
