import random
import re
from collections import Counter

import pytest
from helpers import COPY, EDGE, frame, variants

from territory.llm import jaccard_join
from territory.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(pairs, size):
    out = {}
    for i, text in pairs:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
        out[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    return out


def brute(pairs, least, size):
    sets = sets_of(pairs, size)
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if label[a] > label[b] and common and 100 * common >= least * (len(sets[a]) + len(sets[b]) - common):
                    label[a], changed = label[b], True
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("least, size, seed, length", [(90, 3, 1, 60), (80, 5, 2, 60), (80, 3, 3, 25), (90, 2, 4, 12)])
def test_against_brute_force(spark, least, size, seed, length):
    pairs = variants(seed, groups=5, size=10, length=length)
    out = jaccard_join.similarity_classes(frame(spark, pairs), least, size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(pairs, least, size)


def test_common_passages_do_not_link_but_small_sets_do(spark):
    rng = random.Random(3)
    hot = " ".join(f"h{i}" for i in range(30))
    pairs = [(i, hot + " " + " ".join(f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 40)))) for i in range(30)]
    pairs += [(100, "a b"), (101, "A B"), (102, "a"), (103, "a b c d e f g h i j k l"), (104, "a b c d e f g h i j k l m")]
    out = jaccard_join.similarity_classes(frame(spark, pairs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(pairs, 90, 3)


def test_edge_cases(spark):
    out = jaccard_join.similarity_classes(frame(spark, EDGE)).collect()
    assert len(out) == len(EDGE)
    got = sorted((r.doc_id if r.doc_id is not None else 99, r.n_shingles, r.component_id if r.component_id is not None else 99) for r in out)
    assert [g for g in got if g[0] in (5, 6, 10)] == [(5, 10, 5), (5, 10, 5), (6, 10, 5), (10, 10, 5)]
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert [g for g in got if g[0] == 99] == [(99, 0, 99), (99, 1, 99)]


def test_empty_table(spark):
    assert jaccard_join.similarity_classes(frame(spark, [])).count() == 0


def test_keep_first_keeps_columns(spark):
    docs = frame(spark, [(3, "a b c"), (1, "a  b c"), (2, "z"), (4, "")])
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


def test_keep_first_with_null_and_repeated_ids(spark):
    kept = [(r.doc_id, r.text) for r in jaccard_join.keep_first(frame(spark, EDGE)).collect()]
    expected = [e for e in EDGE if e[1] != COPY and e[0] != 6 and e != (7, COPY + " ")] + [(5, COPY)]
    assert Counter(kept) == Counter(expected)


def test_keep_first_leaves_one_row_of_each_component(spark):
    near = " ".join(f"w{i}" for i in range(100))
    other = near + " more"  # a near copy under the same id
    pairs = [(8, near), (8, near), (8, other), (9, near), (None, near), (None, "z"), (None, "z"), (4, None), (4, None)]
    kept = Counter((r.doc_id, r.text) for r in jaccard_join.keep_first(frame(spark, pairs)).collect())
    assert kept[None, "z"] == 1 and kept[4, None] == 2 and kept[8, near] + kept[8, other] == 1 and sum(kept.values()) == 4


def test_parity_bits_differ_at_most_as_sets_do():
    rng = random.Random(9)
    import numpy as np

    for _ in range(50):
        a, b = (np.unique(np.array([rng.randrange(500) for _ in range(60)], np.uint64)) for _ in range(2))
        apart = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in jaccard_join.parities(a) ^ jaccard_join.parities(b))
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))


def test_a_large_group_of_near_copies_is_compared_with_its_centre(spark, monkeypatch):
    rng, pairs = random.Random(5), []
    for i in range(1400):  # 60 within one change of the text, the others too far from all
        text = [f"w{k}" for k in range(150)]
        for at in rng.sample(range(3, 147, 3), min(i, 1) if i < 60 else rng.randrange(6, 9)):
            text[at] = f"n{rng.randrange(10**9)}"
        pairs.append((i, " ".join(text)))
    compared = []

    def verify(rows, sets, least, run=jaccard_join._verify):
        compared.append(rows.count())
        return run(rows, sets, least)

    monkeypatch.setattr(jaccard_join, "_verify", verify)
    out = jaccard_join.similarity_classes(frame(spark, pairs)).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: 0 if i < 60 else i for i, _ in pairs}
    assert sum(compared) <= 10 * 60, compared


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 30)] + [(7, 7), (2000, 2000)]
    random.Random(2).shuffle(links)
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(30)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
