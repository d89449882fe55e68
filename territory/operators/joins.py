"""Join shapes of the models and serving queries.

No side carries a broadcast hint unless its row count is fixed: Spark
broadcasts a dimension when its size allows, and otherwise shuffles with the
adaptive skew join splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from territory.operators.dedup import keep_first


def restrict_to(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the dimension."""
    return df.join(dimension.select(key), key, "left_semi")


def exclude(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``other``."""
    return df.join(other.select(key).dropDuplicates(), key, "left_anti")


def enrich(base: DataFrame, tables: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Chain of left joins that keeps every row of ``base``."""
    for table in tables:
        base = base.join(table, key, "left")
    return base


def latest_only(df: DataFrame, period: str, present: Column) -> DataFrame:
    """Rows of the last period in which ``present`` holds, those rows only."""
    known = df.filter(present)
    return known.filter(F.col(period) == known.select(F.max(period)).scalar())


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` largest rows; ``ties`` (ascending) make the cut repeatable."""
    order = [F.col(by).desc_nulls_last(), *[F.col(t).asc() for t in ties]]
    return df.orderBy(*order).limit(k)


def members_of(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` for the chosen members."""
    return df.join(chosen.select(key), key, "left_semi")


def lookup_last(
    df: DataFrame, records: DataFrame, key: str, order: Column, required: str
) -> DataFrame:
    """Attach the last record per key; rows without ``required`` are dropped."""
    last = keep_first(records, [key], [order.desc()])
    return df.join(last, key, "left").filter(F.col(required).isNotNull())
