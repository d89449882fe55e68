"""The document pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last give
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from territory.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from territory.llm.blocks import store
from territory.llm.queries import table, vocabulary

#: Near duplicates: words of a shingle, similarity in hundredths.
NEAR_WORDS = 5
NEAR_LEAST = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    return quality.accept(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier; a document of nothing else goes."""
    out = line_dedup.drop_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_first(docs, NEAR_LEAST, NEAR_WORDS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_near),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
