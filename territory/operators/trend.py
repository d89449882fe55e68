"""Change over time and relative rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from territory.functions import clean as C
from territory.operators.order_stats import (
    descending_rank_of,
    long_form,
    percent_rank_of,
    value_ranks,
)
from territory.operators.storage import materialise


def with_previous(
    df: DataFrame, key: str, period: str, measures: Mapping[str, str]
) -> DataFrame:
    """Value of the previous row present for the key; a missing period is
    skipped. One row per key and period, so a window holds a key's periods.
    ``measures`` maps a column to the name of its previous value."""
    w = Window.partitionBy(key).orderBy(period)
    return df.select("*", *[F.lag(m).over(w).alias(name) for m, name in measures.items()])


def cumulative_change(df: DataFrame, key: str, period: str, measure: str, name: str) -> DataFrame:
    """Percentage change since the key's first period."""
    w = Window.partitionBy(key).orderBy(period)
    first = F.first(measure).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(name, C.pct_change(measure, first))


def percentile_columns(
    df: DataFrame, row: Sequence[str], within: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Percent rank of each measure inside ``within``: one row per ``row``
    key, one column per measure. ``row`` includes the columns of ``within``."""
    ranks = value_ranks(df, within, measures).select(
        "key", "measure", "value", percent_rank_of().alias("pr")
    )
    # A row's own key and the key of its ranking, side by side.
    own = df.withColumns({"_row": F.struct(*row)})
    placed = long_form(own, [*within, "_row"], measures).select(
        F.struct(*[F.col(f"key.{c}") for c in within]).alias("key"), "key._row", "measure", "value"
    )
    wide = placed.join(ranks, ["key", "measure", "value"]).groupBy("_row").agg(
        *[F.max(F.when(F.col("measure") == name, F.col("pr"))).alias(name) for name in measures]
    )
    return wide.select("_row.*", *measures)


def composite_index(
    df: DataFrame,
    row: Sequence[str],
    within: Sequence[str],
    components: Mapping[str, tuple[Column, float]],
    name: str,
) -> DataFrame:
    """Weighted sum of component percentiles, itself turned into a percentile
    times 100. Rows with a null component take no part; ``row`` is the key of
    ``df`` and includes ``within``. Returns ``row`` and ``name``.

    Ranking reads its input several times, so the score (a few columns per
    row) is stored before the second ranking, and the index after it.
    """
    columns = {c: column for c, (column, _) in components.items()}
    whole = df
    for column in columns.values():
        whole = whole.filter(column.isNotNull())
    parts = percentile_columns(whole, row, within, columns)
    score = None
    for c, (_, weight) in components.items():
        term = F.col(c) * F.lit(weight)
        score = term if score is None else score + term
    scored = materialise(parts.select(*row, score.alias("_score")))
    final = percentile_columns(scored, row, within, {name: F.col("_score")})
    return materialise(final.withColumn(name, F.round(F.col(name) * 100, 1)))


def rank_by(df: DataFrame, within: Sequence[str], by: str, name: str) -> DataFrame:
    """Rank (1 = largest) of ``by`` inside ``within``; ties share a rank."""
    ranks = value_ranks(df, within, {"by": F.col(by)}).select(
        "key", F.col("value").alias("_value"), descending_rank_of().alias(name)
    )
    placed = df.withColumns({"key": F.struct(*within), "_value": F.col(by).cast("double")})
    return placed.join(ranks, ["key", "_value"], "left").select(*df.columns, name)
