"""Merkle manifest against a plain one, on edge rows and a hot group."""

import hashlib

import pytest
from helpers import EDGE, frame
from pyspark.sql import functions as F

from territory.llm import manifest as M


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fanout=3):
    """(top, path of each node) of a list of digests."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for i, p in enumerate(at):
            run, slot = runs[p // fanout], p % fanout
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[i] = p // fanout
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def plain(rows, fanout=3):
    """Sorted (id, group, leaf, subroot, root, path) of (id, group, leaf) rows."""
    groups = {}
    for i, g, x in rows:
        groups.setdefault((g is not None, (g or "").encode()), []).append((i is not None, i or 0, x, i, g))
    names = sorted(groups)
    trees = [tree([r[2] for r in sorted(groups[n])], fanout) for n in names]
    root, above = tree([t[0] for t in trees], fanout)
    out = []
    for name, (top, paths), up in zip(names, trees, above, strict=True):
        out += [(i, g, x, top, root, p + up) for (_, _, x, i, g), p in zip(sorted(groups[name]), paths, strict=True)]
    return sorted(out, key=repr)


def made(df):
    return sorted(
        [(r.doc_id, r.source, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in df.collect()], key=repr
    )


@pytest.mark.parametrize("fanout", [3, 4])
def test_equals_a_plain_tree_with_a_hot_group(spark, fanout, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_LEVELS", 2)
    sources = ["hot"] * 120 + ["a", "é", "b", "b", None, None, "", "Z"] * 4 + ["lone"]
    rows = [(i * 7 % 1009, s, h(str(i))) for i, s in enumerate(sources)]
    out = M.manifest(spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(5), "leaf", fanout=fanout)
    assert made(out) == plain(rows, fanout)
    assert out.filter(M.fold("leaf", "path") != F.col("root")).count() == 0


@pytest.mark.parametrize("size", [1, 4, 9])
def test_sizes_of_a_single_group(spark, size):
    rows = [(i, "s", h(str(i))) for i in range(size)]
    assert made(M.manifest(spark.createDataFrame(rows, "doc_id long, source string, leaf string"), "leaf")) == plain(rows)


def test_edge_rows_clashing_columns_and_no_rows(spark):
    docs = frame(spark, EDGE).withColumn("source", F.when(F.col("doc_id") != 8, F.lit("s")))
    docs = docs.withColumn("leaf", M.leaf_digest("doc_id", "source", "text")).withColumn("root", F.lit("mine"))
    out = M.manifest(docs.withColumnRenamed("_row", "_group").withColumnRenamed("_id", "_n"), "leaf")
    assert made(out) == plain([(r.doc_id, r.source, r.leaf) for r in docs.collect()])
    assert {"_group", "_n", "text", "key"} <= set(out.columns) and out.columns.count("root") == 1
    assert M.manifest(docs.filter("false"), "leaf").count() == 0


def test_leaf_takes_bytes_nulls_and_empty_texts(spark):
    rows = [(1, "é😀"), (2, ""), (None, None)]
    out = spark.createDataFrame(rows, "doc_id long, text string").select(M.leaf_digest("doc_id", "text").alias("x"))
    assert [r.x for r in out.collect()] == [leaf(*r) for r in rows]
    assert leaf(2, "") == h("1:2", "0:") and leaf(None, None) == h("--")


def test_a_changed_leaf_and_a_changed_proof_give_another_root(spark):
    rows = [(i, "s" if i % 4 else "t", h(str(i))) for i in range(30)]
    out = M.manifest(spark.createDataFrame(rows, "doc_id long, source string, leaf string"), "leaf")
    bad = F.when(F.col("doc_id") == 7, F.lit(h("x"))).otherwise(F.col("leaf"))
    told = out.select("doc_id", (M.fold(bad, "path") == F.col("root")).alias("ok"), M.proof_digest("path").alias("p"), "path")
    for r in told.collect():
        assert r.ok == (r.doc_id != 7)
        assert r.p == h(*[a + z for a, z in r.path])
    swapped = F.transform("path", lambda s: F.struct(s["right"].alias("left"), s["left"].alias("right")))
    assert out.filter(M.fold("leaf", swapped) == F.col("root")).count() == 0


def test_no_exchange_gathers_a_group(spark):
    """Windows are dealt by group and block, joins by group and parent: never by the group alone."""
    from conftest import plan_of

    rows = [(i, "hot", h(str(i))) for i in range(50)]
    plan = plan_of(M.manifest(spark.createDataFrame(rows, "doc_id long, source string, leaf string"), "leaf"))
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
