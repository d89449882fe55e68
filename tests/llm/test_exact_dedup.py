import hashlib
import re
from collections import Counter, defaultdict

import pytest
from helpers import EDGE, frame

from territory.llm import exact_dedup


def brute(pairs):
    groups = defaultdict(list)
    for n, (i, t) in enumerate(pairs):
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((n, i, len(t or "")))
    out = []
    for plain, rows in groups.items():
        best = max(rows, key=lambda r: (r[2], r[1] is not None, -(r[1] or 0)))
        sha = hashlib.sha256(plain.encode()).hexdigest()
        out += [(i, best[1], len(rows), sha) for _, i, _ in rows]
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect())


def test_edge_cases(spark):
    out = exact_dedup.exact_groups(frame(spark, EDGE))
    assert found(out) == brute(EDGE)
    assert out.filter("kept").count() == len({r[3] for r in brute(EDGE)})


def test_texts_that_differ_late_or_end_early(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FIRST_DIGIT", 4)
    monkeypatch.setattr(exact_dedup, "DIGIT_GROWTH", 2)
    base = "abcdefgh" * 40
    pairs = [(n, base[:k] + tail) for n, (k, tail) in enumerate((k, t) for k in (0, 3, 4, 5, 64, 65, 320) for t in ("", "x", "y", "x"))]
    assert found(exact_dedup.exact_groups(frame(spark, pairs))) == brute(pairs)


def test_empty_table(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def test_drop_copies_keeps_columns(spark):
    docs = frame(spark, [(1, "a b"), (2, "ab"), (3, "c")])
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_drop_copies_keeps_one_row_of_each_text_whatever_the_ids(spark):
    pairs = [(None, "a"), (None, "b"), (1, "a"), (2, "c"), (2, "d d"), (2, "c"), (3, None), (None, " ")]
    kept = exact_dedup.drop_copies(frame(spark, pairs)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(None, "b"), (1, "a"), (2, "c"), (2, "d d"), (None, " ")])
    assert {r._row for r in kept} == {"r"}
    edge = exact_dedup.drop_copies(frame(spark, EDGE)).collect()
    assert len(edge) == len({r[3] for r in brute(EDGE)})
    assert exact_dedup.drop_copies(frame(spark, [])).count() == 0


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "xy "), (None, "x y"), ("c", "z")], "doc_id string, text string")
    out = exact_dedup.exact_groups(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out) == Counter(
        [("a", "a", 3, True), ("b", "a", 3, False), (None, "a", 3, False), ("c", "c", 1, True)]
    )
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(docs).collect()) == ["a", "c"]


@pytest.mark.parametrize("n", [500])
def test_one_group_of_a_third_of_all_rows(spark, n):
    pairs = [(i, "hot text" if i % 3 == 0 else f"text {i // 2}") for i in range(n)]
    assert found(exact_dedup.exact_groups(frame(spark, pairs))) == brute(pairs)
