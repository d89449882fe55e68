"""Exact deduplication by distributed most-significant-digit radix partitioning.

Documents are split by the next run of bytes of their normalised text, again
and again, until a group has one document or its texts have ended. A digit is
a run of bytes, compared as it is: no digest decides equality. A round is one
grouped count (combined before the shuffle) and one join back to the documents
of groups that still hold several; both carry the digit, never a whole text,
as key. A hot group is only a hot join key, which the adaptive skew join
splits, and its count is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from territory.llm.blocks import store, wrapped

#: Fixed value: characters that do not count.
BLANKS = "[\\x20\\x09-\\x0D]"
#: Bytes of the first digit and the factor by which each next one is longer.
FIRST_DIGIT = 64
DIGIT_GROWTH = 16
#: A later digit is at most this long, so a key stays small.
LONGEST_DIGIT = 1 << 20


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its group of equal texts and the row that stays.

    Columns: the id, ``keep_id`` (id of the row that stays), ``group_size``,
    ``kept`` and ``text_sha256`` of the normalised text. The row with the most
    code points stays, then the smallest id (of any type that has an order;
    nulls last), then the first in storage order.

    A null text counts as empty; empty texts form one group. Rows that repeat
    an id or a text are rows of their own. An empty table gives no rows. Other
    columns, whatever their names, are ignored.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return _classes(numbered).select(F.col("_id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text equals that of the row that stays.

    Rows are told apart by a stored number, not by their ids: of every
    different text one row stays, also where ids are null or repeat. Columns
    and their names are kept; nulls, empty texts, ties and empty tables are
    treated as by ``exact_groups``.
    """
    numbered = store(wrapped(docs, F.monotonically_increasing_id().alias("_row")), "exact-docs")
    fields = {"_id": id_col, "_text": text_col}
    stays = _classes(numbered.select("_row", *[F.col("_doc")[field].alias(name) for name, field in fields.items()]))
    return numbered.join(stays.filter("kept").select("_row"), "_row", "left_semi").select("_doc.*")


def _classes(numbered: DataFrame) -> DataFrame:
    """The groups of rows (_row, _id, _text), by row."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    plain = F.encode(F.regexp_replace(text, BLANKS, ""), "UTF-8")
    rows = store(
        numbered.select(
            "_row", "_id", F.length(text).alias("_points"), F.sha2(plain, 256).alias("text_sha256"), plain.alias("_rest")
        ),
        "exact-rows",
    )
    state = rows.select("_row", F.lit(-1).cast("long").alias("_group"), "_rest")
    width, found = FIRST_DIGIT, []
    while True:
        digit = F.substring("_rest", 1, width)
        rest = F.col("_rest").substr(F.lit(width + 1), F.greatest(F.octet_length("_rest") - width, F.lit(0)))
        split = state.select("_row", "_group", digit.alias("_digit"), rest.alias("_tail"))
        shared = (
            split.groupBy("_group", "_digit")
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_next"))
            .filter("_n > 1")
        )
        left = store(
            split.join(shared, ["_group", "_digit"]).select(
                "_row",
                F.col("_next").alias("_group"),
                F.col("_tail").alias("_rest"),
                (F.octet_length("_digit") < width).alias("_ended"),
            ),
            "exact-round",
        )
        found.append(left.filter("_ended").select("_row", "_group"))
        state = left.filter("not _ended").select("_row", "_group", "_rest")
        if state.isEmpty():
            break
        width = min(width * DIGIT_GROWTH, LONGEST_DIGIT)
    grouped = found[0]
    for part in found[1:]:
        grouped = grouped.unionByName(part)
    members = (
        rows.select("_row", "_id", "_points", "text_sha256")
        .join(grouped, "_row", "left")
        .withColumn("_group", F.coalesce("_group", "_row"))
    )
    members = store(members, "exact-members")
    best = F.min_by(
        F.struct("_row", "_id"),
        F.struct(-F.col("_points"), F.col("_id").isNull(), "_id", "_row"),
    )
    heads = members.groupBy("_group").agg(F.count(F.lit(1)).alias("group_size"), best.alias("_best"))
    return members.join(heads, "_group").select(
        "_row",
        "_id",
        F.col("_best._id").alias("keep_id"),
        "group_size",
        (F.col("_best._row") == F.col("_row")).alias("kept"),
        "text_sha256",
    )
