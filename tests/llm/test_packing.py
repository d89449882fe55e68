import random
import zlib

import numpy as np
import pytest
from helpers import EDGE, frame
from pyspark.sql import functions as F

from territory.llm import packing
from territory.llm.queries import vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("length", [7, 1024])
def test_round_trip(spark, tokenizer, length):
    docs = frame(spark, EDGE)
    pieces = packing.pack_documents(docs, vocabulary(), length, with_ids=True)
    rows = sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset))
    at = {}
    for r in rows:  # gapless from offset 0, all full but the last
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    assert sorted(at) == list(range(len(at))) and all(n == length for s, n in at.items() if s < len(at) - 1)
    stream = np.frombuffer(b"".join(bytes(r.ids) for r in rows), "<u4").tolist()
    ends = [0, *(k + 1 for k, x in enumerate(stream) if x == 0)]
    texts = sorted(tuple(stream[a:b]) for a, b in zip(ends, ends[1:]))
    expected = sorted(tuple(ids_of(tokenizer, t)) for _, t in EDGE if 0 not in ids_of(tokenizer, t)[:-1])
    assert texts == expected
    assert all(r.doc_tokens in {len(x) for x in expected} for r in rows)


def test_words_on_their_own_give_the_ids_of_the_text(tokenizer):
    words, rng = packing.WordIds(tokenizer), random.Random(4)
    parts = [" ", "  ", "\n", "\t", "a", "word", "é", "\xa0", "　", ".", "'s", "12", "\x00", "\x1c", "!!", "日本", "\r\n", "I'm", "\x85", "👍", ",'s", "²"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 20)))
        assert np.frombuffer(next(words.batch([text])), words.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_sequences_are_padded_except_at_a_power_of_two(spark):
    pieces = spark.createDataFrame(
        [(0, 0, np.array([5, 6], "<u4").tobytes()), (0, 2, np.array([7], "<u4").tobytes()), (1, 0, np.array([8, 9], "<u4").tobytes())],
        "sequence_id long, offset long, ids binary",
    )
    got = {r.sequence_id: (r.ids, r.n_tokens) for r in packing.sequences(pieces, 8).collect()}
    assert got == {0: ([5, 6, 7, 0, 0, 0, 0, 0], 3), 1: ([8, 9], 2)}


def test_empty_table(spark):
    assert packing.pack_documents(frame(spark, []), vocabulary()).count() == 0


def test_ids_of_rows_with_nulls_keep_all_bits(spark):
    docs = spark.createDataFrame([(2**62 + 1, "a"), (None, "b")], "doc_id long, text string").repartition(1)
    out = packing.pack_documents(docs, vocabulary()).agg(F.max("doc_id")).first()
    assert out[0] == 2**62 + 1


def test_words_repeated_over_a_chunk_of_texts_are_looked_up_once():
    rows = [(i, " ".join(f"w{k}" for k in range(2000))) for i in range(600)]  # 6.5 MB of 2,000 words
    seen = []

    class Counted(packing.WordIds):
        def learn(self, parts):
            seen.append(len(parts))
            super().learn(parts)

    sizes = packing.byte_sizes("text")
    import pandas as pd
    from tokenizers import Tokenizer

    words = Counted(Tokenizer.from_file(vocabulary()))
    made = [b for c in packing.chunks([pd.DataFrame(rows, columns=["id", "text"])], sizes, packing.CHUNK_BYTES) for b in words.batch(c["text"].tolist())]
    assert len(set(made)) == 1 and np.frombuffer(made[0], words.kind).tolist() == ids_of(words.tokenizer, rows[0][1])[:-1]
    assert len(seen) == 1, seen
