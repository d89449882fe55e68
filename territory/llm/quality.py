"""Quality classifier: supervised subword embeddings of words and character n-grams, softmax output."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from territory.llm import subword
from territory.llm.blocks import text_batches, wrapped

FEATURES = subword.Features(grams=(3, 4), words=True, repeats=True, bits=16)
#: Labelled rows that training takes at most (about).
SAMPLE_ROWS = 8000
#: A document with a lower score is rejected.
ACCEPT = 0.3
GOOD = "1"


def fit(
    docs: DataFrame,
    labels: DataFrame,
    known: Column | None = None,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> subword.Model:
    """A model of ``label_col`` (0 or 1) as ``labels`` gives it for rows of ``docs``.

    Learns from about ``sample_rows`` labelled rows where ``known`` (a
    condition on the id) holds, chosen by a hash of the id. Labels other than
    0 and 1, rows without a label and ids that are null are not used; of
    labels that disagree on an id the larger holds.
    """
    marks = (
        labels.filter(F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("_key"))
        .agg(F.max(label_col).cast("int").alias("_mark"))
    )
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    if known is not None:
        rows, marks = rows.filter(known), marks.withColumnRenamed("_key", id_col).filter(known).withColumnRenamed(id_col, "_key")
    n = marks.count()
    spot = F.pmod(F.xxhash64("_key", F.lit("label")), F.lit(subword.SAMPLE_BUCKETS))
    share = min(subword.SAMPLE_BUCKETS, -(-subword.SAMPLE_BUCKETS * sample_rows // max(n, 1)))
    taken = F.broadcast(marks.filter(spot < F.lit(share)))  # about sample_rows small rows
    joined = rows.join(taken, rows[id_col] == taken["_key"]).select("_key", "_mark", "text")
    bags = subword.labelled_bags(joined, F.col("_mark"), F.col("_key"), "text", FEATURES, sample_rows)
    return subword.train(bags, FEATURES, ["0", GOOD])


def score(docs: DataFrame, model: subword.Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``name`` (which replaces such a column).

    A null or empty text gets the score of no features at all: the share of
    label 1 among the rows learned from, as calibrated. One row for each row.
    """
    docs = docs.drop(name)
    shared = text_batches(docs.sparkSession).sparkContext.broadcast(model)
    fields = docs.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        good = model.classes.index(GOOD)
        for batch in batches:
            values = [float(model.probabilities(text.as_py())[good]) for text in batch.column(text_col)]
            names = [*(f.name for f in fields), name]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names)

    return docs.mapInArrow(run, StructType([*fields, StructField(name, DoubleType())]))


def accept(docs: DataFrame, model: subword.Model, text_col: str = "text", least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``least``, with the columns of ``docs``."""
    rows = wrapped(docs, docs[text_col])
    return score(rows, model, text_col, "_quality").filter(F.col("_quality") >= least).select("_doc.*")
