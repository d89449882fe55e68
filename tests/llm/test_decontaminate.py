import random
import re

import pytest
from helpers import EDGE, frame

from territory.llm import decontaminate

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(pairs, items, size):
    out = {}
    for i, text in pairs:
        words, hit, names = WORDS.findall((text or "").translate(LOWER)), set(), set()
        for key, item in items:
            w = WORDS.findall((item or "").translate(LOWER))
            for s in range(len(w) - min(size, len(w)) + 1):
                window = w[s : s + size]
                for k in range(len(words) - len(window) + 1):
                    if window and words[k : k + len(window)] == window and key is not None:
                        hit |= set(range(k, k + len(window)))
                        names.add(str(key))
        out[i] = (len(words), len(hit), sorted(names))
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block", [10, 8 << 20])
def test_against_brute_force(spark, block):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(["Aa", "b", "é", "7", "b-b", "c,"]) for _ in range(n))
    items = [(k, text(rng.randrange(0, 8))) for k in range(6)] + [(9, None), (None, "b b b"), (11, "!!"), (0, "b")]
    pairs = [(i, text(rng.randrange(0, 40))) for i in range(30)]
    out = decontaminate.find_leaks(frame(spark, pairs), bench(spark, items), 4, block_bytes=block).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.items) for r in out} == brute(pairs, items, 4)
    for r in out:  # offsets of the original
        words = [WORDS.findall(r.text.translate(LOWER))[s.first : s.last + 1] for s in r.word_spans]
        assert [WORDS.findall(r.text[s.first : s.last].translate(LOWER)) for s in r.char_spans] == words


def test_edge_cases(spark):
    docs, items = frame(spark, EDGE), bench(spark, [(1, "two lines of one document"), (2, "X")])
    out = decontaminate.find_leaks(docs, items).collect()
    assert len(out) == len(EDGE)
    assert sorted(r.doc_id for r in out if r.n_hit) == [5, 5, 6, 7, 8, 10]
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(EDGE) - 6
    assert {r.n_words for r in kept.collect()} == {"n"}


def test_empty_tables(spark):
    items = bench(spark, [(1, "a")])
    assert decontaminate.find_leaks(frame(spark, []), items).count() == 0
    assert decontaminate.drop_contaminated(frame(spark, EDGE), bench(spark, [])).count() == len(EDGE)
