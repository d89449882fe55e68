import random
import re
from collections import Counter

import pytest
from helpers import EDGE, frame

from territory.llm import line_dedup


def brute(pairs, least):
    """Text that is left of each row whose id is not repeated: maximal equal runs with every earlier place."""
    docs = {}
    for i, text in sorted(pairs):
        lines = text.split("\n")
        docs[i] = lines, [(n, x.strip(line_dedup.BLANKS)) for n, x in enumerate(lines) if x.strip(line_dedup.BLANKS)]
    out = {}
    for i, (lines, solid) in docs.items():
        gone = set()
        for j, (_, other) in docs.items():
            for shift in range(-len(other), len(solid)) if j <= i else ():
                run = []
                for k in range(len(solid) + 1):
                    at = k - shift
                    if k < len(solid) and 0 <= at < len(other) and (j < i or at < k) and other[at][1] == solid[k][1]:
                        run.append(k)
                        continue
                    if sum(len(re.findall("[^\x20\x09-\x0d]+", solid[x][1])) for x in run) >= least and run:
                        gone |= {solid[x][0] for x in run}
                    run = []
        out[i] = ("\n".join(x for n, x in enumerate(lines) if n not in gone), len(gone))
    return out


@pytest.mark.parametrize("least", [1, 6, 20])
def test_against_brute_force(spark, least):
    rng = random.Random(least)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 9))) for _ in range(25)]
    pairs = [(i, "\n".join(rng.choice([*pool, "", "  "]) for _ in range(rng.randrange(0, 14)))) for i in range(60)]
    out = line_dedup.mark_repeats(frame(spark, pairs), least).collect()
    assert {r.doc_id: (r.kept_text, r.n_removed) for r in out} == brute(pairs, least)


def test_a_passage_of_fifty_words_goes_with_all_lines_of_its_run(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    docs = frame(spark, [(1, f"one\n{passage}\nshort line"), (2, f"two\n{passage}\nshort line"), (3, passage), (4, "clean\nshort line")])
    out = {r.doc_id: r.text for r in line_dedup.drop_repeats(docs).collect()}
    assert out == {1: f"one\n{passage}\nshort line", 2: "two", 4: "clean\nshort line"}


@pytest.mark.parametrize("shape", [[70, 45], [60, 20, 15], [30, 30, 5], [2, 55], [5, 30, 30, 5], [20, 31], [1] * 49 + [1], [49], [25, 24]])
def test_runs_go_whole_whatever_the_lengths_of_their_lines(shape):
    """A run with 50 words is covered by windows of either direction; a shorter one has none."""
    lines = [" ".join(f"w{n}_{i}" for i in range(size)) for n, size in enumerate(shape)]
    found = list(line_dedup.windows(lines, 50))
    covered = {k for _, _, first, last, _ in found for k in range(first, last + 1)}
    assert covered == (set(range(len(lines))) if sum(shape) >= 50 else set())
    assert len({(first, last) for _, _, first, last, _ in found}) == len(found)


def test_a_match_is_extended_beyond_the_first_place_of_its_fingerprint(spark):
    """The tail is extended against any earlier place, not only the first one of the long line."""
    long = " ".join(f"p{i}" for i in range(70))
    docs = frame(spark, [(1, f"{long}\nother"), (2, f"{long}\ntail of it"), (3, f"new\n{long}\ntail of it\nend")])
    out = {r.doc_id: (r.kept_text, r.n_runs) for r in line_dedup.mark_repeats(docs).collect()}
    assert out == {1: (f"{long}\nother", 0), 2: ("tail of it", 1), 3: ("new\nend", 1)}


def test_edge_cases(spark):
    docs = frame(spark, EDGE)
    out = line_dedup.mark_repeats(docs, 5)
    rows = out.collect()
    assert len(rows) == len(EDGE)
    assert all(r.kept_text is None and r.n_lines == 0 for r in rows if r.text is None)
    left = Counter((r.doc_id, r.kept_text) for r in rows if r.text and r.text.startswith("the same"))
    assert left[5, EDGE[5][1]] == 2  # a row repeated whole is the same document
    assert left[6, ""] == left[10, ""] == 1
    kept = line_dedup.drop_repeats(docs, 5)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, None, 1, 2, 3, 4, 5, 5, 7, 8, 9])
    assert {r.n_words for r in kept.collect()} == {"n"}


def test_empty_table(spark):
    assert line_dedup.mark_repeats(frame(spark, [])).count() == 0


def test_every_window_holds_its_fingerprint():
    lines = [f"a{i % 7} b c" for i in range(40)]
    for fp, anchor, first, last, _ in line_dedup.windows(lines, 10):
        hashes = [line_dedup.hash_of(x) for x in lines[first : last + 1]]
        assert fp == min(hashes) and anchor == first + hashes.index(min(hashes))
