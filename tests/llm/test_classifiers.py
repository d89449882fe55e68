import random

from helpers import EDGE, frame
from pyspark.sql import functions as F

from territory.llm import language, quality, subword

FRENCH, ENGLISH = "le chat noir dort sur la table et mange".split(), "the black cat sleeps on a table and eats".split()


def texts(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(FRENCH if i % 2 else ENGLISH) for _ in range(rng.randrange(5, 40)))) for i in range(n)]


def labelled(spark, pairs):
    return frame(spark, pairs).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "fr").otherwise("en"))


def test_language_on_rows_not_learned_from(spark):
    model = language.fit(labelled(spark, texts(400, 1)), F.col("doc_id") % 5 != 0)
    out = language.predict(labelled(spark, texts(400, 2)).filter("doc_id % 5 = 0"), model).collect()
    assert sum(r.lang_pred == r.lang for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in out) and model.facts["held_back"] > 0


def test_language_edge_cases(spark):
    model = language.fit(labelled(spark, texts(200, 1)), F.lit(True))
    out = language.predict(frame(spark, [*EDGE, (20, "12 34 !?")]).withColumn("lang_pred", F.lit("old")), model).collect()
    assert len(out) == len(EDGE) + 1
    assert {r.lang_pred for r in out if not (r.text or "").strip() or r.doc_id == 20} == {"und"}
    assert {r.lang_pred for r in out if r.doc_id in (4, 5, 8, 9)} <= {"fr", "en"}
    assert language.predict(frame(spark, []), model).count() == 0
    nothing = language.fit(labelled(spark, []), F.lit(True))
    assert {r.lang_pred for r in language.predict(frame(spark, EDGE), nothing).collect()} == {"und"}


def test_language_of_foreign_text_is_rejected_more_often(spark):
    model = language.fit(labelled(spark, texts(400, 1)), F.lit(True))
    known = language.predict(frame(spark, texts(100, 3)), model).filter("rejected").count()
    strange = [(i, " ".join(random.Random(i).choices(["zqx", "wvk", "xxq", "qqz"], k=4))) for i in range(100)]
    assert language.predict(frame(spark, strange), model).filter("rejected").count() > known


def junk(n, seed):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        words = [rng.choice(ENGLISH) for _ in range(rng.randrange(5, 40))]
        kind = i % 3
        made.append((i, " ".join(words) if kind else " ".join(w + "$$$" for w in words) if i % 2 else " ".join([words[0]] * 20)))
    return made


def test_quality_on_rows_not_learned_from(spark):
    docs = frame(spark, junk(600, 1))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"), F.lit(9).alias("text"))
    model = quality.fit(docs, labels, F.col("doc_id") < 400)
    out = quality.score(frame(spark, junk(600, 2)).filter("doc_id >= 400"), model).collect()
    assert sum((r.score >= 0.3) == (r.doc_id % 3 != 0) for r in out) >= 0.97 * len(out)


def test_quality_edge_cases(spark):
    docs = frame(spark, junk(200, 1)).withColumn("_quality", F.lit("own"))
    labels = spark.createDataFrame(
        [(i, int(i % 3 != 0)) for i in range(200)] + [(None, 1), (5, None), (6, 7), (7, 0)], "doc_id long, quality int"
    )
    model = quality.fit(docs, labels)
    edge = frame(spark, EDGE).withColumn("_quality", F.lit("own"))
    out = quality.score(edge, model).collect()
    assert len(out) == len(EDGE) and all(0 <= r.score <= 1 for r in out)
    kept = quality.accept(edge, model)
    assert kept.columns == edge.columns and {r["_quality"] for r in kept.collect()} == {"own"}
    assert quality.score(frame(spark, []), model).count() == 0
    blank = quality.fit(docs, labels.filter("false"))
    assert quality.score(edge, blank).filter("score = 0.5").count() >= 5


def test_a_long_text_is_read_whole():
    what, size = subword.Features(), subword.STRETCH_BYTES
    text = "ab " * (size // 2)
    ids, counts = subword.bag(text, what)
    words = text.split()
    assert counts.sum() >= len(words) + len(text) * 2 - 50
    assert subword.bag(None, what)[0].size == subword.bag("", what)[0].size == 0
