"""Line deduplication by winnowing over line hashes.

The lines of a document that are not blank form a sequence. A window is a
shortest run of lines that holds at least ``RUN_WORDS`` words: one that begins at
a line and goes on until it has them, or one that ends at a line and goes back
until it has them. Of every window the line with the smallest hash (the leftmost,
if several) is its fingerprint: equal windows choose the same line, so a run that
repeats is sure to share a fingerprint, and only windows whose fingerprint occurs
at several places are joined to positions.

A match is extended both ways from there, line by line: a line before it
belongs to the run if the window that begins at it stands earlier too, a line after
it if the window that ends at it does. The runs so found are the maximal ones:
a line goes if and only if it lies in a run of at least ``RUN_WORDS`` words that
stands earlier, whichever earlier place that is, and no two documents are ever
compared as a pair. What is left of a run's first place stays.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from territory.llm.blocks import forget, store, text_batches, wrapped

#: Words that a run of lines needs to be deleted when it repeats.
RUN_WORDS = 50

#: White space around and between words; words.
BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile("[^\x20\x09-\x0d]+")

#: A null id comes after all others.
LAST_ID = (1 << 63) - 1

WINDOWS = "id long, key long, fp long, anchor int, first int, last int, mark binary"


def hash_of(line: str) -> int:
    """Signed 64-bit hash of a line."""
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def solid_lines(text: str) -> list[tuple[int, str]]:
    """Numbers and stripped texts of the lines that are not blank."""
    stripped = ((n, line.strip(BLANKS)) for n, line in enumerate(text.split("\n")))
    return [(n, line) for n, line in stripped if line]


def windows(lines: list[str], least: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(fingerprint, its place, first, last, 128-bit mark) of every window, each once.

    Places count solid lines from 0. Windows that begin at each line come first, then those that end at
    each line and are no shortest run from their own first line. The two ends only move forward, and a
    queue of ascending hashes gives each window's minimum, so the work is in
    proportion to the lines and to the lines of the windows.
    """
    ends = list(accumulate((len(WORD.findall(line)) for line in lines), initial=0))
    hashes = [hash_of(line) for line in lines]
    raw = [h.to_bytes(8, "big", signed=True) for h in hashes]
    for spans in (_forward(ends, least), _backward(ends, least)):
        upto, queue, head = -1, [], 0
        for first, last in spans:
            for n in range(upto + 1, last + 1):
                while len(queue) > head and hashes[queue[-1]] > hashes[n]:
                    queue.pop()
                queue.append(n)
            upto = max(upto, last)
            while queue[head] < first:
                head += 1
            mark = hashlib.blake2b(b"".join(raw[first : last + 1]), digest_size=16).digest()
            yield hashes[queue[head]], queue[head], first, last, mark


def _forward(ends: list[int], least: int) -> Iterator[tuple[int, int]]:
    """The shortest run from each line on that holds ``least`` words; ``ends`` are running counts of words."""
    last, count = 0, len(ends) - 1
    for first in range(count):
        last = max(last, first)
        while last < count and ends[last + 1] - ends[first] < least:
            last += 1
        if last == count:
            return
        yield first, last


def _backward(ends: list[int], least: int) -> Iterator[tuple[int, int]]:
    """The shortest run up to each line that holds ``least`` words, unless it also is the shortest from its first line."""
    first = 0
    for last in range(len(ends) - 1):
        if ends[last + 1] - ends[0] < least:
            continue
        while first < last and ends[last + 1] - ends[first + 1] >= least:
            first += 1
        if last > first and ends[last] - ends[first] >= least:
            yield first, last


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(text).alias("key"),
        text.alias("text"),
    ]


def repeated_windows(
    docs: DataFrame, least: int = RUN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Windows that stand earlier too: id, key (of the text), first, last (solid lines).

    Those of a run overlap or touch; together they are the run, extended both ways.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        names = ["id", "key", "fp", "anchor", "first", "last", "mark"]
        for frame in frames:
            out = []
            for key, hashed, text in frame.itertuples(index=False, name=None):
                lines = [line for _, line in solid_lines(text)]
                out.extend((key, hashed, *found) for found in windows(lines, least))
                if len(out) > 100_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    text_batches(docs.sparkSession)
    found = store(docs.select(*_keyed(docs, id_col, text_col)).mapInPandas(run, WINDOWS), "line-windows")
    place = F.struct("id", "key", "anchor")
    shared = found.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("z")).filter("a != z").select("fp")
    joined = store(found.join(shared, "fp").select("id", "key", "first", "last", "mark"), "line-positions")
    start = F.struct("id", "key", "first")
    earliest = joined.groupBy("mark").agg(F.min(start).alias("a"), F.max(start).alias("z")).filter("a != z")
    return joined.join(earliest.select("mark", "a"), "mark").filter(start != F.col("a")).select("id", "key", "first", "last")


def united(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Inclusive runs united where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def mark_repeats(
    docs: DataFrame, least: int = RUN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the new text and counts of what was deleted.

    New columns (they replace columns of these names): ``kept_text`` (the text
    without the deleted lines, other lines as they were, blank lines too),
    ``n_lines`` (solid lines), ``n_removed`` of them and ``n_runs`` (maximal
    runs of removed solid lines).

    A run of lines with ``least`` words is deleted if an equal one stands earlier: in a row with a smaller
    id (null ids last), in a row of the same id with a smaller text hash, or
    earlier in the same text. A row that repeats both id and text is the same
    document and gets the same result. Null texts stay null with no lines. An
    empty table gives no rows; other columns stay.
    """
    new = ["kept_text", "n_lines", "n_removed", "n_runs"]
    docs = docs.drop(*new)
    later = repeated_windows(docs, least, id_col, text_col)
    runs = later.groupBy("id", "key").agg(F.collect_list(F.struct("first", "last")).alias("_runs"))
    id_, key, _ = _keyed(docs, id_col, text_col)
    joined = wrapped(docs, id_, key, F.col(text_col).alias("text")).join(runs, ["id", "key"], "left")

    @F.pandas_udf("kept_text string, n_lines long, n_removed long, n_runs long")
    def rewrite(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(texts, found, strict=True):
            if text is None:
                out.append((None, 0, 0, 0))
                continue
            solid = solid_lines(text)
            if spans is None:
                out.append((text, len(solid), 0, 0))
                continue
            spans = united([(s["first"], s["last"]) for s in spans])
            gone = {solid[i][0] for first, last in spans for i in range(first, last + 1)}
            left = [line for n, line in enumerate(text.split("\n")) if n not in gone]
            out.append(("\n".join(left), len(solid), len(gone), len(spans)))
        return pd.DataFrame(out, columns=new)

    made = joined.withColumn("_made", rewrite("text", "_runs"))
    return made.select("_doc.*", *(F.col(f"_made.{n}").alias(n) for n in new))


def drop_repeats(
    docs: DataFrame, least: int = RUN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with repeated runs of lines deleted from the text.

    Rows whose every solid line was deleted go; rows that had none stay.
    Columns stay the same; a count of characters beside the text is the
    caller's to renew.
    """
    rows = wrapped(docs, docs[id_col], docs[text_col])
    marked = mark_repeats(rows, least, id_col, text_col)
    left = marked.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return left.select(F.col("_doc").withField(f"`{text_col}`", F.col("kept_text")).alias("_doc")).select("_doc.*")
