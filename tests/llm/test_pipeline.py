import zlib

import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as leaks
from test_jaccard_join import brute as near
from test_line_dedup import brute as lines

import corpus_pipeline
from territory.llm import quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    folder = tmp_path_factory.mktemp("stages")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        before, docs = docs, spark.read.parquet(f"{folder}/{k}")
        out[name] = ([tuple(r) for r in before.collect()], docs)
    return out


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def test_columns_of_documents_stay(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert all(after.dtypes == columns for name, (_, after) in stages.items() if name != "packing")


def test_quality_rejects_what_scores_low(spark, stages):
    before, after = stages["quality classifier"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scored if r.score >= quality.ACCEPT}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id for r in after.collect()}
    right = [(i in kept) == bool(q) for i, q in marks.items()]
    assert sum(right) >= 0.95 * len(right) and len(kept) < len(before)


def test_lines(stages):
    before, after = stages["line dedup"]
    expected = lines(pairs(before), 50)
    words = lambda t: bool(t.split())
    left = {i: t for i, (t, n) in expected.items() if not n or words(t)}
    rows = after.collect()
    assert {r.doc_id: r.text for r in rows} == left and all(r.n_chars == len(r.text) for r in rows)


def test_near_duplicates(stages):
    before, after = stages["n-gram Jaccard join"]
    components = near(pairs(before), 80, 5)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, c) in components.items() if i == c)


def test_leaks(spark, stages):
    before, after = stages["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = leaks(pairs(before), items, 10)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, hit, _) in found.items() if not hit)


def test_packing_and_run(spark, stages):
    from tokenizers import Tokenizer

    from territory.llm.queries import vocabulary

    tokenizer = Tokenizer.from_file(vocabulary())
    before, after = stages["packing"]
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in pairs(before)}
    rows = after.collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in piece)) == r.ids_crc32
    whole = corpus_pipeline.run(spark, SF)
    tokens = lambda df: sorted(tuple(r) for r in df.groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens")).collect())
    assert tokens(whole) == tokens(after)
