"""Vector code compression by product codes, in exact integer arithmetic.

Vectors become integers and are cut into consecutive parts; each part is
replaced by the index of the nearest entry of its codebook. Distances come from
one matrix product per part position: integers are broken into limbs so small
that every float64 product sum of the BLAS stays below 2^53 and is exact, and
the products are put together again in int64. Results therefore depend neither
on the order of rows nor on how Spark partitions them.

A round reads the stored integers once; a task sends one row per codebook
entry, and the driver receives the summed codebook only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from territory.llm.blocks import store

PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Integers are this many times the components, rounded down.
SCALE = 4096
#: Integers up to 2^53 are exact in a float64.
EXACT_BITS = 53


def largest(dimension: int) -> int:
    """Magnitude up to which the sums of a distance over ``dimension`` components fit 64 bits."""
    return math.isqrt(((1 << 63) - 1) // (4 * max(1, dimension)))


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as float64 limbs of ``bits`` bits, lowest first; the last one carries the sign."""
    out = []
    while values.size and max(int(values.max()), -int(values.min())) >> bits:
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*out, values.astype(np.float64)]


def dot_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All dot products of the rows of two int64 matrices, exact where they fit 64 bits."""
    bits = (EXACT_BITS - max(0, a.shape[1] - 1).bit_length()) // 2
    right = limbs(b, bits)
    total = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            total += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(values: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of the nearest entry and the squared distance, for each row of ``values``."""
    scores = (entries * entries).sum(axis=1) - 2 * dot_products(values, entries)
    index = scores.argmin(axis=1)
    return index, scores[np.arange(len(values)), index] + (values * values).sum(axis=1)


def cuts(dimension: int, parts: int) -> list[tuple[int, int]]:
    """Ends of ``parts`` consecutive parts; the first ones are longer by one if there is a remainder."""
    size, more = divmod(dimension, parts)
    ends = [0]
    for p in range(parts):
        ends.append(ends[-1] + size + (p < more))
    return list(zip(ends[:-1], ends[1:], strict=True))


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> tuple[DataFrame, int]:
    """The usable rows as ``_doc`` (the other columns) and ``_ints``, stored; and their dimension."""
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double") * scale)
    others = [F.col(f"`{c}`") for c in vectors.columns if c != vector_col]
    rows = vectors.select(F.struct(*others).alias("_doc"), F.col(id_col).alias("_id"), vector.alias("_vector"))
    size = F.size("_vector")
    # Half of 2^63 and the dimension in doubles: the bound is checked once more, in integers, below.
    finite = F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**61))
    kept = rows.filter(F.col("_vector").isNotNull() & (size > 0) & finite).select(
        "_doc", "_id", F.transform("_vector", lambda x: F.floor(x).cast("long")).alias("_ints")
    )
    first = kept.orderBy(F.col("_id").asc_nulls_last(), "_ints").limit(1).select(F.size("_ints")).first()
    dimension = first[0] if first else 0
    bound = largest(dimension)
    small = F.forall("_ints", lambda x: F.abs(x) <= bound)
    return store(kept.filter((F.size("_ints") == dimension) & small), "vector-ints"), dimension


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dimension)


def _sums(ints: DataFrame, books: list[np.ndarray], spans: list[tuple[int, int]], dimension: int) -> DataFrame:
    """Rows (part, entry, place, total): how many parts chose an entry (place -1) and their component sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(book), hi - lo + 1), np.int64) for book, (lo, hi) in zip(books, spans, strict=True)]
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column(0), dimension)
            for book, (lo, hi), total in zip(books, spans, totals, strict=True):
                index, _ = nearest(values[:, lo:hi], book)
                order = np.argsort(index, kind="stable")
                chosen, starts = np.unique(index[order], return_index=True)
                total[chosen, 0] += np.diff(starts, append=len(order))
                total[chosen, 1:] += np.add.reduceat(values[order, lo:hi], starts, axis=0)
        rows = [
            (part, entry, place - 1, int(total[entry, place]))
            for part, total in enumerate(totals)
            for entry in np.flatnonzero(total[:, 0])
            for place in range(total.shape[1])
        ]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "entry", "place", "total"]
        )

    sent = ints.select("_ints").mapInArrow(run, "part int, entry int, place int, total long")
    return sent.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))


def learn(
    ints: DataFrame, dimension: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> list[np.ndarray]:
    """A codebook (int64 matrix) for each part position.

    It starts from the rows with the smallest ids. Each round assigns all
    rows, then an entry becomes the mean of its parts, rounded down; an entry
    that no part chose stays.
    """
    spans = cuts(dimension, parts)
    first = ints.orderBy(F.col("_id").asc_nulls_last(), "_ints").limit(entries).select("_ints").collect()
    start = np.array([r[0] for r in first], np.int64).reshape(len(first), dimension)
    books = [start[:, lo:hi].copy() for lo, hi in spans]
    for _ in range(rounds if first else 0):
        counts: dict[tuple[int, int], int] = {}
        found = _sums(ints, books, spans, dimension).collect()  # parts x entries x (part length + 1) rows
        counts = {(r["part"], r["entry"]): r["total"] for r in found if r["place"] < 0}
        for r in found:
            if r["place"] >= 0:
                books[r["part"]][r["entry"], r["place"]] = r["total"] // counts[r["part"], r["entry"]]
    return books


def encode(ints: DataFrame, books: list[np.ndarray], dimension: int) -> DataFrame:
    """The columns of ``_doc``, ``codes`` (an index per part) and ``error`` (squared distance over all parts)."""
    spans = cuts(dimension, len(books))
    doc = ints.schema["_doc"]
    schema = T.StructType([doc, T.StructField("_codes", T.ArrayType(T.IntegerType())), T.StructField("_error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column(1), dimension)
            codes = np.empty((len(values), len(books)), np.int32)
            error = np.zeros(len(values), np.int64)
            for p, (book, (lo, hi)) in enumerate(zip(books, spans, strict=True)):
                codes[:, p], distance = nearest(values[:, lo:hi], book)
                error += distance
            ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(books))
            lists = pa.ListArray.from_arrays(ends, pa.array(codes.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(error)], ["_doc", "_codes", "_error"])

    coded = ints.select("_doc", "_ints").mapInArrow(run, schema)
    others = [f"_doc.`{n}`" for n in doc.dataType.names if n not in ("codes", "error")]
    return coded.select(*others, F.col("_codes").alias("codes"), F.col("_error").alias("error"))


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Vectors as short codes: the coded rows and the codebooks.

    The vector column gives way to ``codes`` and ``error`` (these replace
    columns of these names); every other column stays, whatever its name.

    Rows go whose vector is null, empty or holds a null or non-finite
    component. So do vectors of another length than that of the smallest id,
    and vectors with integers beyond ``largest`` of that length, whose
    distances do not fit 64 bits (2^27.5, or components of 46,000, for 64
    components). Ids order the first entries, null ids last, equal ids by their
    integers; fewer rows than ``entries`` give fewer entries. Repeated rows count
    each. A length that ``parts`` does not divide gives parts whose lengths differ by one.
    An empty table gives no rows and codebooks without entries.
    """
    ints, dimension = integer_vectors(vectors, id_col, vector_col, scale)
    books = learn(ints, dimension, parts, entries, rounds)
    return encode(ints, books, dimension), books


def decode(codes: np.ndarray, books: list[np.ndarray], scale: int = SCALE) -> np.ndarray:
    """Approximate vectors of a matrix of codes."""
    return np.concatenate([book[codes[:, p]] for p, book in enumerate(books)], axis=1) / scale


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components, in decimal, by part, entry and position."""
    numbers = (str(v) for book in books for v in book.reshape(-1).tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()
