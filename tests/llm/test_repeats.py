import random
from collections import Counter

import numpy as np
import pytest
from helpers import COPY, EDGE, frame

from territory.llm import repeats


def brute(pairs, length):
    seen, out = set(), {}
    for i, text in sorted(pairs):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                gone[s : s + length] = True
            seen.add(data[s : s + length])
        out[i] = np.frombuffer(data, np.uint8)[~gone].tobytes()
    return out


@pytest.mark.parametrize("length, gram, alphabet", [(20, 8, "ab"), (20, 8, "abcdefé "), (33, 16, "abc")])
def test_against_brute_force(spark, length, gram, alphabet):
    rng = random.Random(length + len(alphabet))
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    pool = [make(rng.randrange(10, 90)) for _ in range(12)]
    pairs = [(i, "".join(rng.choice([*pool, make(15)]) for _ in range(rng.randrange(0, 7)))) for i in range(50)]
    pairs.append((50, "a" * 300))
    out = repeats.mark_repeats(frame(spark, pairs), length, gram).collect()
    assert {r.doc_id: bytes(r.kept) for r in out} == brute(pairs, length)
    assert all(r.n_bytes - r.n_removed == len(r.kept) == r.n_bytes - sum(s.end - s.start for s in r.spans) for r in out)


@pytest.mark.parametrize("name, value", [("SPREAD_OVER", 1), ("STRETCH", 64), ("CHUNK_BYTES", 100)])
def test_other_ways_of_dealing_give_the_same(spark, monkeypatch, name, value):
    monkeypatch.setattr(repeats, name, value)
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcdef ") for _ in range(60)) for _ in range(6)]
    pairs = [(i, "".join(rng.choice(pool)[rng.randrange(9) :] for _ in range(4))) for i in range(40)]
    out = repeats.mark_repeats(frame(spark, pairs), 25, 8).collect()
    assert {r.doc_id: bytes(r.kept) for r in out} == brute(pairs, 25)


def test_edge_cases(spark):
    rows = repeats.mark_repeats(frame(spark, EDGE), 20, 8).collect()
    assert len(rows) == len(EDGE)
    assert all(bytes(r.kept) == b"" and r.n_bytes == 0 for r in rows if not r.text)
    copies = Counter((r.doc_id, len(r.kept)) for r in rows if r.text and r.text.startswith("the same"))
    assert copies[5, len(COPY)] == 2 and copies[6, 0] == copies[10, 0] == 1  # rows repeated whole are one document
    assert {r.label for r in rows} == {"l"}


def test_empty_table(spark):
    assert repeats.mark_repeats(frame(spark, [])).count() == 0


def test_longest_previous_factor_by_suffix_order():
    rng = random.Random(1)
    data = bytes(rng.choice(b"ab") for _ in range(400))
    starts = np.arange(len(data) - 12 + 1)
    ranks = repeats.window_ranks(np.frombuffer(data, np.uint8), starts, 12)
    strings = [data[s : s + 12] for s in starts]
    order = sorted(set(strings))
    assert ranks.tolist() == [order.index(x) for x in strings]
    assert repeats.has_earlier(ranks, starts).tolist() == [x in strings[:s] for s, x in enumerate(strings)]


def test_smaller_before():
    values = np.array([5, 3, 4, 4, 1, 2, 9, 2])
    assert repeats.smaller_before(values).tolist() == [-1, -1, 1, 1, -1, 4, 5, 4]
