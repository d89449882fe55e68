"""Stupid-backoff language-model scores against n-gram counts of the whole collection.

The n-grams of a chunk of documents are exploded, counted within the chunk and
sent to the bucket of their hash, where the count table of that bucket is
summed up and joined back: every chunk gets the collection's counts of its own
n-grams, sums its documents and keeps nothing else. No table of n-grams ever
stands in one place.

Longer n-grams follow the shorter ones: a trigram is only asked for if both
bigrams inside it occur more than once, for otherwise it cannot occur
elsewhere. N-grams are 64-bit hashes of 64-bit word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from territory.llm.blocks import (
    ASKED,
    U64,
    ask_rows,
    buckets_of,
    byte_sizes,
    chunks,
    count_tables,
    join_hashes,
    pack,
    pack_sorted,
    store,
    text_batches,
    totals_of,
    unpack,
    unpack_sorted,
)
from territory.llm.subword import LOWER, long_word_hashes, stretches

BACKOFF = 0.4
CHUNK_BYTES = 8 << 20

STATE = "chunk long, ids array<string>, sizes binary, vocabulary binary, words binary, n long"
SCORES = "id string, n_words long, n_trigrams long, n_bigrams long, n_unigrams long, n_unseen long, log_score double"

#: Fixed value: bytes between words.
BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def words_of(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, A-Z lowered."""
    parts = stretches((text or "").encode("utf-8", "surrogatepass"))
    return long_word_hashes((LOWER[part], BLANK[part]) for part in parts)


def _states(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    chunk = TaskContext.get().partitionId() << 32
    for frame in chunks(frames, byte_sizes("text"), CHUNK_BYTES):
        found = [words_of(t if isinstance(t, str) else None) for t in frame["text"]]
        vocabulary, words = np.unique(np.concatenate(found), return_inverse=True)
        sizes = np.array([len(f) for f in found], np.int64)
        yield pd.DataFrame(
            {
                "chunk": [chunk],
                "ids": [frame["id"].tolist()],
                "sizes": [pack(sizes)],
                "vocabulary": [pack_sorted(vocabulary)],
                "words": [pack(words.astype(np.uint32))],
                "n": [int(sizes.sum())],
            }
        )
        chunk += 1


class Chunk:
    """A chunk's words and the n-grams that end at each of them."""

    def __init__(self, row):
        self.ids = list(row.ids)
        self.sizes = unpack(row.sizes, np.int64)
        self.vocabulary = unpack_sorted(row.vocabulary)
        self.words = unpack(row.words, np.uint32)
        self.document = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.place = np.arange(len(self.words)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Where n-grams of ``order`` end, and their hashes."""
        ends = np.flatnonzero(self.place >= order - 1)
        hashes = self.vocabulary[self.words]
        return ends, join_hashes(np.full(len(ends), order, U64), *(hashes[ends - k] for k in range(order - 1, -1, -1)))

    def short(self):
        """Distinct unigrams and bigrams, places of both and counts."""
        ends, grams = self.grams(2)
        alone = join_hashes(np.ones(len(self.vocabulary), U64), self.vocabulary)
        distinct, inverse, counts = np.unique(
            np.concatenate([alone, grams]), return_inverse=True, return_counts=True
        )
        times = np.bincount(self.words, minlength=len(alone))
        counts[inverse[: len(alone)]] = times
        return distinct, counts, inverse[: len(alone)], ends, inverse[len(alone) :]

    def long(self, bigram_total: np.ndarray):
        """Distinct trigrams worth asking for, their counts, and where they end; needs the bigrams' totals by place."""
        ends, grams = self.grams(3)
        asked = (bigram_total[ends] > 1) & (bigram_total[ends - 1] > 1)
        distinct, inverse, counts = np.unique(grams[asked], return_inverse=True, return_counts=True)
        return distinct, counts, ends[asked], inverse


def _own(document: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often the document of each place holds the n-gram of that place."""
    _, inverse, counts = np.unique((document.astype(np.int64) << 32) | gram, return_inverse=True, return_counts=True)
    return counts[inverse]


def _score(row, total_words: int, backoff: float, leave_out: bool) -> pd.DataFrame:
    chunk = Chunk(row)
    _, _, uni_at, bi_ends, bi_at = chunk.short()
    short = totals_of(row.lm_short)
    n = len(chunk.words)
    uni, bi = short[uni_at][chunk.words], np.zeros(n, np.int64)
    tri = (chunk.place >= 2).astype(np.int64)  # one that was not asked for occurs here only
    bi[bi_ends] = short[bi_at]
    _, _, tri_ends, tri_at = chunk.long(bi)
    tri[tri_ends] = totals_of(row.lm_long)[tri_at]
    words_elsewhere = np.full(len(chunk.sizes), total_words, np.int64)
    if leave_out:
        uni = uni - _own(chunk.document, chunk.words)
        bi[bi_ends] -= _own(chunk.document[bi_ends], bi_at)
        asked = np.zeros(n, bool)
        asked[tri_ends] = True
        tri[~asked] = 0
        tri[tri_ends] -= _own(chunk.document[tri_ends], tri_at)
        words_elsewhere -= chunk.sizes
    context2, context1 = np.zeros(n, np.int64), np.zeros(n, np.int64)
    context2[1:], context1[1:] = bi[:-1], uni[:-1]
    by3, by2 = tri > 0, (tri <= 0) & (bi > 0)
    by1 = ~by3 & ~by2
    steps = np.minimum(chunk.place, 2)  # orders above the unigram that a place has
    base = np.maximum(words_elsewhere, 1)[chunk.document]
    chance = np.empty(n)
    chance[by3] = tri[by3] / context2[by3]
    chance[by2] = bi[by2] / context1[by2]
    chance[by1] = np.maximum(uni[by1], 1) / base[by1]
    back = np.where(by3, 0, np.where(by2, steps - 1, steps))
    logs = np.log(chance) + back * np.log(backoff)
    sums = lambda x: np.bincount(chunk.document, x, len(chunk.sizes))
    unseen = by1 & (uni <= 0)
    return pd.DataFrame(
        {
            "id": chunk.ids,
            "n_words": chunk.sizes,
            "n_trigrams": sums(by3).astype(np.int64),
            "n_bigrams": sums(by2).astype(np.int64),
            "n_unigrams": sums(by1 & ~unseen).astype(np.int64),
            "n_unseen": sums(unseen).astype(np.int64),
            "log_score": sums(logs),
        }
    )


def lm_scores(
    docs: DataFrame,
    backoff: float = BACKOFF,
    leave_out: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Trigram stupid-backoff score of every row of ``docs`` under counts of all rows.

    One row per row: the id, ``n_words``, how many words were scored by a
    trigram, bigram, unigram or not seen, and ``log_score``, the sum over the
    words of ln S. S(w | u v) is c(u v w) / c(u v) if that trigram occurs, else
    ``backoff`` times S(w | v), which is c(v w) / c(v) if that bigram occurs,
    else ``backoff`` times c(w) / N; a word that does not occur counts as one.
    The first words of a text start with the shorter context they have.

    With ``leave_out`` a row's own n-grams are taken from the counts (and its
    words from N) before it is scored: a text is judged by all other rows, its
    copies included. Without it, every n-gram has been seen.

    Words are runs without ASCII white space, A-Z lowered, of any length. A
    null or empty text has no words and score 0.
    Ids may be null or repeat; each row counts. An empty table gives no rows.
    """
    spark = text_batches(docs.sparkSession)
    buckets = buckets_of(spark)
    plain = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    state = store(plain.mapInPandas(_states, STATE), "lm-state")
    total = state.agg(F.sum("n")).first()[0] or 0

    def ask_short(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                grams, counts, *_ = Chunk(row).short()
                yield ask_rows(row.chunk, grams, counts, buckets)

    def ask_long(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                chunk = Chunk(row)
                _, _, _, ends, at = chunk.short()
                bigrams = np.zeros(len(chunk.words), np.int64)
                bigrams[ends] = totals_of(row.lm_short)[at]
                grams, counts, *_ = chunk.long(bigrams)
                yield ask_rows(row.chunk, grams, counts, buckets)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield _score(row, total, backoff, leave_out)

    short = count_tables(state.mapInPandas(ask_short, ASKED), "lm_short")
    known = state.join(short, "chunk", "left")
    long = count_tables(known.mapInPandas(ask_long, ASKED), "lm_long")
    scores = known.join(long, "chunk", "left").mapInPandas(score, SCORES)
    return scores.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)
