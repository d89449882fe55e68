"""Registered queries against their SQL, and the contract's held-out folds."""

import binascii

import pytest

from contract.compare import connect, difference, to_pandas
from territory.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    expected = to_pandas(connect(SF).sql(ORACLES[name]).to_arrow_table())
    assert difference(to_pandas(QUERIES[name](spark, SF)), expected) is None


@pytest.mark.parametrize("name, folds, held", [("op4_language_id", 4, 2), ("op10_quality", 5, 0)])
def test_folds_and_held_out_accuracy(spark, name, folds, held):
    out = QUERIES[name](spark, SF).collect()
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % folds == held) for r in out)
    if name == "op4_language_id":
        truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
        got = {r.doc_id: r.lang_pred for r in out}
    else:
        truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
        got = {r.doc_id: r.predicted for r in out}
    tried = [r.doc_id for r in out if r.held_out and r.doc_id in truth]
    assert sum(got[i] == truth[i] for i in tried) >= 0.9 * len(tried)
