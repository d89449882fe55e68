"""Keeping one row, or a set of values, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the stated order.

    ``row_number() = 1`` is planned with a group limit in front of the
    shuffle, so a key with very many rows sends one row per map task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_largest(
    df: DataFrame, key: str, by: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Row with the largest ``by`` per key, nulls last; ``ties`` (ascending)
    make the choice repeatable."""
    order = [F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    return keep_first(df, [key], order)


def first_values(df: DataFrame, key: str, values: Sequence[str], order: Column) -> DataFrame:
    """``values`` of the first row per key, by aggregation."""
    packed = F.min_by(F.struct(*values), order).alias("_first")
    return df.groupBy(key).agg(packed).select(key, "_first.*")


def distinct_values(df: DataFrame, key: str, member: str) -> DataFrame:
    """Set of members per key, as rows rather than one array per key."""
    return df.select(key, member).dropDuplicates()
