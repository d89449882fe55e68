"""Exact medians and ranks for groups of any size.

The built-in exact ``median`` keeps all distinct values of a group in one
task, and ``percent_rank`` sorts a whole partition in one task. Either fails
when one group holds a large part of the data. Here

1. rows collapse to a frequency table (group, measure, value, n), with partial
   counts before the shuffle, spread over tasks by value;
2. each measure gets split points: quantile sketches of hash buckets of that
   table, each in a task of its own, give a few values per bucket, and the
   splits are picked from these. The splits only balance the work: a value's
   chunk is the number of splits below it, so chunks are ordered whatever the
   sketches return, and results stay exact;
3. chunk totals (at most ``chunks`` rows per group) give the number of rows in
   front of each chunk;
4. running counts inside a chunk finish the position of each value. A chunk
   holds about 1/chunks of the frequency table, also in the largest group.

Steps 2-4 read the same shuffle, which Spark reuses.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from territory.functions.clean import safe_divide


#: Chunks whose splits one hash bucket's sketch helps to find.
BUCKET_CHUNKS = 64


def chunk_count(spark: SparkSession) -> int:
    """Chunks per measure: a power of two, a few per shuffle task."""
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(2, 1 << (wanted - 1).bit_length())


def long_form(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """One row per input row and measure: (key, measure, value), nulls left out.

    The keys travel as one struct: it is never null, so joins on it keep the
    groups whose key columns are null, as grouping does.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), column.cast("double").alias("value"))
            for name, column in measures.items()
        ]
    )
    exploded = df.select(F.struct(*keys).alias("key"), F.explode(pairs).alias("pair"))
    return exploded.select("key", "pair.measure", "pair.value").filter("value is not null")


def value_counts(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Frequency table: one row per (key, measure, value)."""
    return long_form(df, keys, measures).groupBy("key", "measure", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


_GROUP = ("key", "measure")


def _add_chunk(counts: DataFrame, chunks: int) -> DataFrame:
    """Number the ordered chunk of each value, per measure."""
    buckets = max(1, chunks // BUCKET_CHUNKS)
    picks = 4 * chunks // buckets
    cuts = ", ".join(f"{i / picks}D" for i in range(1, picks))
    # The condition on n keeps the frequency table's columns, and so its
    # shuffle, the same for all of its readers.
    sketches = counts.filter("n > 0").groupBy("measure", F.expr(f"pmod(xxhash64(value), {buckets})").alias("bucket"))
    few = sketches.agg(F.expr(f"percentile_approx(value, array({cuts}), {4 * picks})").alias("picked"))
    ordered = few.select("measure", F.explode("picked").alias("v")).groupBy("measure").agg(
        F.sort_array(F.collect_list("v")).alias("v")
    )
    splits = ordered.selectExpr(
        "measure", f"transform(sequence(1, {chunks - 1}), i -> v[int(floor(i * double(size(v)) / {chunks}))]) as splits"
    )
    # Binary search: the number of splits below the value, one halving per step.
    step = chunks // 2
    search, found = [f"if(splits[{step - 1}] < value, {step}, 0) as p{step}"], f"p{step}"
    while step > 1:
        step //= 2
        search.append(f"{found} + if(splits[{found} + {step - 1}] < value, {step}, 0) as p{step}")
        found = f"p{step}"
    # One row per measure, a number fixed by the caller.
    return (
        counts.join(F.broadcast(splits), "measure")
        .selectExpr(*counts.columns, *search)
        .selectExpr(*counts.columns, f"{found} as chunk")
    )


def _chunk_positions(chunked: DataFrame, sums: bool = False) -> DataFrame:
    """Per (group, chunk): rows in front of it, its rows, and group totals."""
    weighted = "value * n"
    sizes = chunked.groupBy(*_GROUP, "chunk").agg(
        F.expr("sum(n) as chunk_n"),
        F.expr(f"sum({weighted}) as chunk_sum" if sums else "cast(null as double) as chunk_sum"),
    )
    return sizes.selectExpr(
        *_GROUP,
        "chunk",
        "chunk_n",
        "sum(chunk_n) over (partition by key, measure order by chunk"
        " rows between unbounded preceding and current row) - chunk_n as before",
        "sum(chunk_n) over (partition by key, measure) as total",
        "sum(chunk_sum) over (partition by key, measure) as total_sum",
    )


def _running(chunked: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows strictly below each value of its group, as ``below``."""
    below = (
        "before + sum(n) over (partition by key, measure, chunk order by value"
        " rows between unbounded preceding and current row) - n as below"
    )
    return chunked.join(positions, [*_GROUP, "chunk"]).selectExpr("*", below)


def exact_medians(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], sums: bool = True
) -> DataFrame:
    """Per key and measure ``m``: ``m_count``, ``m_median``, ``m_sum``, ``m_mean``.

    The median of an even number of rows is the mean of the middle two. Sums
    are sums of doubles; without ``sums`` the last two columns are left out.
    """
    chunked = _add_chunk(value_counts(df, keys, measures), chunk_count(df.sparkSession))

    # Ranks (from 1) of the middle rows; the chunks holding them are at most two.
    low, high = "(total + 1) div 2", "total div 2 + 1"
    positions = _chunk_positions(chunked, sums).filter(
        f"before < {high} and before + chunk_n >= {low}"
    )
    picked = _running(chunked, positions.drop("chunk_n")).filter(
        f"below < {high} and below + n >= {low}"
    )
    aggregates, columns = [], []
    for m in measures:
        this = f"if(measure = '{m}', {{}}, null)"
        total, total_sum, value = (this.format(c) for c in ("total", "total_sum", "value"))
        aggregates += [
            f"max({total}) as {m}_count", f"(min({value}) + max({value})) / 2 as {m}_median"
        ]
        columns += [f"{m}_count", f"{m}_median"]
        if sums:
            aggregates.append(f"max({total_sum}) as {m}_sum")
            columns += [f"{m}_sum", f"{m}_sum / {m}_count as {m}_mean"]
    wide = picked.groupBy("key").agg(*[F.expr(a) for a in aggregates])
    return wide.selectExpr("key.*", *columns)


def value_ranks(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Rank table: (key, measure, value, n, below, total) for every value."""
    chunked = _add_chunk(value_counts(df, keys, measures), chunk_count(df.sparkSession))
    positions = _chunk_positions(chunked).select(*_GROUP, "chunk", "before", "total")
    return _running(chunked, positions).drop("chunk", "before")


def percent_rank_of() -> Column:
    """``(rank - 1) / (rows - 1)`` over a rank table; 0 for a single row."""
    return F.coalesce(safe_divide(F.col("below"), F.col("total") - 1), F.lit(0.0))


def descending_rank_of() -> Column:
    """Rank from the largest value, ties sharing the best rank."""
    return F.col("total") - F.col("below") - F.col("n") + 1
