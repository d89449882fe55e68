"""Benchmark decontamination with one Aho-Corasick automaton.

The normalised windows of all test items go into one automaton; every
document is normalised and scanned once. A match is found in the normalised
text and mapped back to word numbers and to code points of the original.

Normalised: bytes of UTF-8 with A-Z lowered, words joined by one blank, a
blank at either end, so a window matches whole words only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from territory.llm.blocks import text_batches, wrapped

WINDOW_WORDS = 10
#: Item bytes that go into one automaton (some hundred megabytes of nodes); more items make further scans.
BLOCK_BYTES = 256 << 10

#: Fixed value: a word of the original text (code points).
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Bytes to their normal form: letters lowered, all other ASCII but digits blank.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Normalised words of a text; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def windows_of(words: list[bytes], size: int) -> Iterator[bytes]:
    """Every run of ``size`` words, or all words if there are fewer but not none."""
    for start in range(max(len(words) - size + 1, min(1, len(words)))):
        yield b" ".join(words[start : start + size])


class Scanner:
    """The automaton over a block of items."""

    def __init__(self, items: Iterable[tuple[str, str | None]], size: int):
        holders: dict[bytes, set[str]] = {}
        for key, text in items:
            for window in windows_of(words_of(text), size):
                holders.setdefault(window, set()).add(key)
        self.automaton = ahocorasick.Automaton()
        for window, keys in holders.items():
            padded = b" " + window + b" "
            self.automaton.add_word(padded.decode("latin-1"), (len(padded), tuple(keys)))
        self.empty = not holders
        if holders:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit runs of words (first, last), items with a match."""
        words = words_of(text)
        if self.empty or not words:
            return len(words), [], set()
        normal = b" " + b" ".join(words) + b" "
        matches = [(end, *found) for end, found in self.automaton.iter(normal.decode("latin-1"))]
        if not matches:
            return len(words), [], set()
        blanks = np.flatnonzero(np.frombuffer(normal, np.uint8) == 32)
        ends = np.array([m[0] for m in matches])
        first = np.searchsorted(blanks, ends - np.array([m[1] for m in matches]) + 1)
        last = np.searchsorted(blanks, ends) - 1
        return len(words), merged(sorted(zip(first.tolist(), last.tolist(), strict=True))), set().union(
            *(m[2] for m in matches)
        )


def merged(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Inclusive runs in ascending order, united where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for first, last in runs:
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points (start, end exclusive) of runs of words in the original text."""
    wanted = {n for run in runs for n in run}
    at = {n: m.span() for n, m in enumerate(WORD.finditer(text)) if n in wanted}
    return [(at[first][0], at[last][1]) for first, last in runs]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of at most ``most`` bytes (a longer item stands alone)."""
    block, total = [], 0
    for key, text in benchmark.select(F.col(item_col).cast("string"), F.col(text_col)).toLocalIterator():
        if key is None or not text:
            continue
        size = len(text.encode("utf-8", "surrogatepass"))
        if block and total + size > most:
            yield block
            block, total = [], 0
        block.append((key, text))
        total += size
    if block:
        yield block


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` and hit spans.

    New columns: ``n_words``, ``n_hit`` (words inside a matched window),
    ``items`` (sorted ids, as strings, of items with a match), ``word_spans``
    (first and last word of each hit run) and ``char_spans`` (code points,
    end exclusive, of the same runs). They replace columns of these names.

    The items go to the executors in blocks of bounded bytes. A benchmark of
    ordinary size is one block, so one automaton and one scan; a larger one
    takes a further scan per block. A null or empty text has no words; an item
    without id, text or words matches nothing; an empty benchmark leaves every
    document clean; equal items are all reported. Rows stay as they are, one
    out for each in.
    """
    spark, out = text_batches(docs.sparkSession), docs.drop(*ADDED)
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    first = next(blocks, [])
    out = _scan(out, spark.sparkContext.broadcast(first), window, text_col, False)
    for block in blocks:
        out = _scan(out, spark.sparkContext.broadcast(block), window, text_col, True)
    return out


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
#: Columns that ``find_leaks`` adds, with their types.
ADDED = {
    "n_words": pa.int64(),
    "n_hit": pa.int64(),
    "items": pa.list_(pa.string()),
    "word_spans": SPANS,
    "char_spans": SPANS,
}


def _scan(docs: DataFrame, items, window: int, text_col: str, again: bool) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in ADDED]
    spans = "array<struct<first:bigint,last:bigint>>"
    added = f"n_words bigint, n_hit bigint, items array<string>, word_spans {spans}, char_spans {spans}"
    schema = StructType([*kept, *StructType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(items.value, window)
        for batch in batches:
            new: dict[str, list] = {name: [] for name in ADDED}
            before = [batch.column(n).to_pylist() for n in ("items", "word_spans")] if again else None
            for i, text in enumerate(batch.column(text_col)):
                text = text.as_py()
                n, runs, keys = scanner.scan(text)
                if again:
                    keys |= set(before[0][i])
                    runs = merged(sorted([*runs, *((r["first"], r["last"]) for r in before[1][i])]))
                new["n_words"].append(n)
                new["n_hit"].append(sum(last - first + 1 for first, last in runs))
                new["items"].append(sorted(keys))
                new["word_spans"].append([{"first": x, "last": y} for x, y in runs])
                new["char_spans"].append([{"first": x, "last": y} for x, y in original_spans(text, runs)] if runs else [])
            columns = [batch.column(f.name) for f in kept] + [pa.array(new[n], t) for n, t in ADDED.items()]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), *ADDED])

    return docs.mapInArrow(run, schema)




def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a window of a test item."""
    text_col = options.get("text_col", "text")
    return find_leaks(wrapped(docs, docs[text_col]), benchmark, **options).filter("n_hit = 0").select("_doc.*")
