"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from territory.llm import (
    decontaminate, exact_dedup, jaccard_join, language, line_dedup, lm_score, manifest, packing, pii, quality, repeats,
    vector_codes, warc,
)
from territory.llm.blocks import store
from territory.llm.oracles import ORACLE_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Path of the byte-level vocabulary file that every worker has."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def fold(id_col: str, folds: int) -> Column:
    """Fold of an id: CRC-32 of its text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def items_digest(items: str) -> Column:
    return F.sha2(F.concat_ws(",", F.col(items)).cast("binary"), 256)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_score.lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 4))
    return scores.withColumn("mean_log_score", mean).drop("log_score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.mark_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, fold("doc_id", 4) != 2)
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    out = language.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        items_digest("items").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def _joined(spans: str) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    base = F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, _joined("spans").alias("spans"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = repeats.mark_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted")
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    cut = F.when(fold("doc_id", 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        manifest.leaf_digest(*fields).alias("leaf"),
        manifest.leaf_digest(*fields[:-1], cut).alias("tampered"),
    )
    folded = manifest.fold("tampered", "path")
    proofs = manifest.manifest(leaves, "leaf").withColumn("folded_root", folded)
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest("path").alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    records = warc.round_trip(pages, payloads=False)
    return records.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    coded, books = vector_codes.compress(vectors)
    coded = store(coded, "vector-codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_line_dedup": op2_line_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_pii": op8_pii,
    "op9_repeats": op9_repeats,
    "op10_quality": op10_quality,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_warc": op12_warc,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES = ORACLE_SQL
