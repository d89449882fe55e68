import math
import random
import re
from collections import Counter

import pytest
from helpers import EDGE, frame

from territory.llm import blocks, jaccard_join, lm_score, subword

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(words):
    return Counter(tuple(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


def brute(pairs, leave_out):
    texts = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) for _, t in pairs]
    everywhere, total = Counter(), sum(map(len, texts))
    for words in texts:
        everywhere.update(grams(words))
    out = []
    for (i, _), words in zip(pairs, texts, strict=True):
        own = grams(words) if leave_out else Counter()
        c = lambda g: everywhere[g] - own[g]  # noqa: B023,E731
        n, score = max(total - (len(words) if leave_out else 0), 1), 0.0
        for k in range(len(words)):
            for order in range(min(3, k + 1), 0, -1):
                gram = tuple(words[k - order + 1 : k + 1])
                if order == 1:
                    score += math.log(max(c(gram), 1) / n)
                elif c(gram) > 0:
                    score += math.log(c(gram) / c(gram[:-1]))
                    break
                else:
                    score += math.log(0.4)
        out.append((i, len(words), score))
    return sorted(out, key=str)


@pytest.mark.parametrize("leave_out", [True, False])
@pytest.mark.parametrize("chunk", [60, 8 << 20])
def test_against_brute_force(spark, monkeypatch, leave_out, chunk):
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", chunk)
    rng = random.Random(1)
    pairs = [(i, " ".join(rng.choice("the The of a cat dog ran").__str__() + rng.choice(["", "s"]) for _ in range(rng.randrange(0, 25)))) for i in range(40)]
    out = lm_score.lm_scores(frame(spark, pairs), leave_out=leave_out).collect()
    got = sorted(((r.doc_id, r.n_words, r.log_score) for r in out), key=str)
    expected = brute(pairs, leave_out)
    assert [g[:2] for g in sorted(got)] == [e[:2] for e in sorted(expected)]
    assert [g[2] for g in sorted(got)] == pytest.approx([e[2] for e in sorted(expected)])
    assert all(r.n_trigrams + r.n_bigrams + r.n_unigrams + r.n_unseen == r.n_words for r in out)


def test_edge_cases(spark):
    out = lm_score.lm_scores(frame(spark, EDGE)).collect()
    assert len(out) == len(EDGE)
    got = sorted((str(r.doc_id), r.n_words, round(r.log_score, 6)) for r in out)
    assert got == sorted((str(i), n, round(s, 6)) for i, n, s in brute(EDGE, True))


def test_empty_table(spark):
    assert lm_score.lm_scores(frame(spark, [])).count() == 0


def test_packed_arrays_come_back():
    import numpy as np

    for values in (np.array([], np.uint64), np.array([3, 3, 2**63, 2**64 - 1], np.uint64)):
        assert blocks.unpack_sorted(blocks.pack_sorted(values)).tolist() == values.tolist()
    some = np.array([-5, 7, 2**31 - 1], np.int32)
    assert blocks.unpack(blocks.pack(some), np.int32).tolist() == some.tolist()


@pytest.mark.parametrize("gap", ["\n", "\t", "\r\n", " ", "\x0b"])
def test_words_of_texts_of_several_stretches(gap):
    rng = random.Random(7)
    words = [f"Wörd{rng.randrange(10**6)}" for _ in range(250_000)]
    text = gap.join(words)
    assert len(text.encode()) > 2 * subword.STRETCH_BYTES
    assert lm_score.words_of(text).tolist() == lm_score.words_of(gap.join(words[:60_000])).tolist() + [
        h for k in range(60_000, 250_000, 60_000) for h in lm_score.words_of(gap.join(words[k : k + 60_000])).tolist()
    ]
    shifted = jaccard_join.shingles("x" + gap + text, 3)
    assert len(set(jaccard_join.shingles(text, 3).tolist()) - set(shifted.tolist())) == 0


@pytest.mark.parametrize("edge", [-2, -1, 0, 1, 2])
def test_words_of_more_than_a_stretch(edge):
    size = subword.STRETCH_BYTES
    long, longer = "a" * (size + edge), "b" * (3 * size + edge)
    texts = [longer, f"{long} x", f"{long}\n{longer}", f"x\t{longer}\ty\n", f"{long} ", f" {longer}", f"{' ' * size}{long}{' ' * size}z"]
    parts = {w: lm_score.words_of("c" + w)[:1].tolist() for w in (long, longer)}
    for text in texts:
        found = lm_score.words_of(text).tolist()
        assert len(found) == len(text.split())
    assert lm_score.words_of(f"{long} x {long}").tolist()[::2] == lm_score.words_of(f"y\n{long}\t{long}").tolist()[1:]
    assert lm_score.words_of(longer).tolist() == lm_score.words_of(f"q {longer.upper()}\n").tolist()[1:]
    assert parts[long] != lm_score.words_of(long).tolist() and parts[longer] != lm_score.words_of(longer).tolist()
