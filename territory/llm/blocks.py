"""Blocks of arrays: how operators move billions of small values through Spark.

A Spark row for every n-gram or anchor costs far more than the value itself.
The operators here let a task work through its documents in chunks of bounded
bytes, and ship for each chunk and hash bucket *one* row whose binary columns
hold whole arrays. Spark still partitions, shuffles and retries those rows.
Repeated values are merged within a chunk before they are shipped, so a value
that a third of all documents hold costs one entry per chunk, not one per
document.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from territory.operators.storage import checkpoint_folder, copies

U64 = np.uint64

#: Odd multipliers of the 64-bit finalizer.
MIX_1 = U64(0xBF58476D1CE4E5B9)
MIX_2 = U64(0x94D049BB133111EB)
SALT = U64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    out = values ^ (values >> U64(30))
    out *= MIX_1
    out ^= out >> U64(27)
    out *= MIX_2
    out ^= out >> U64(31)
    return out


def join_hashes(*parts: np.ndarray) -> np.ndarray:
    """One hash for several aligned hash arrays; the order of the parts counts."""
    out = mix(parts[0] + SALT)
    for part in parts[1:]:
        out = mix(out * MIX_2 + part)
    return out


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, planes of equal byte position together."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(data: bytes, dtype) -> np.ndarray:
    """The array that ``pack`` was given."""
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, kept as differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, dtype=U64) -> np.ndarray:
    """The array that ``pack_sorted`` was given."""
    return np.cumsum(unpack(data, dtype), dtype=dtype)


def bucket_bounds(ordered: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in ascending hashes; a bucket is a hash range."""
    edges = [(b << 64) // buckets for b in range(buckets)]
    return np.append(np.searchsorted(ordered, np.array(edges, U64)), len(ordered))


#: Rows that go to a Python worker at a time: rows hold whole texts.
BATCH_ROWS = 1000


def text_batches(spark: SparkSession) -> SparkSession:
    """Let the session hand texts to Python workers in smaller batches than the default of 10,000 rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def buckets_of(spark: SparkSession) -> int:
    """Number of hash buckets: the session's shuffle partitions, which follow the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: What operators keep in a Python worker from task to task, by name.
REMEMBERED: dict[str, object] = {}


def forget() -> None:
    """Give back what other operators left in this worker, and memory that is held for nothing.

    Workers serve one stage after the other; an operator with large arrays starts with this.
    """
    REMEMBERED.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


ASKED = "chunk long, bucket int, grams binary, counts binary"
TOLD = "chunk long, bucket int, totals binary"


def ask_rows(chunk: int, grams: np.ndarray, counts: np.ndarray, buckets: int) -> pd.DataFrame:
    """A chunk's distinct hashes (ascending) and their counts, an ``ASKED`` row per bucket."""
    bounds = bucket_bounds(grams, buckets)
    rows = [
        (chunk, b, pack_sorted(grams[lo:hi]), pack(counts[lo:hi].astype(np.int32)))
        for b, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
        if hi > lo
    ]
    return pd.DataFrame(rows, columns=["chunk", "bucket", "grams", "counts"])


def tell_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """The count table of a bucket, joined back to every chunk that asked: ``TOLD`` rows."""
    asked = [unpack_sorted(g) for g in frame["grams"]]
    edges = np.cumsum([0, *(len(a) for a in asked)])
    _, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.bincount(inverse, np.concatenate([unpack(c, np.int32) for c in frame["counts"]])).astype(np.int64)
    parts = [pack(totals[inverse[lo:hi]]) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
    return pd.DataFrame({"chunk": frame["chunk"], "bucket": frame["bucket"], "totals": parts})


def totals_of(told) -> np.ndarray:
    """A chunk's totals in the order of its hashes, from the answers of all buckets."""
    ordered = sorted(told if told is not None else (), key=lambda t: t["bucket"])
    return np.concatenate([unpack(t["totals"], np.int64) for t in ordered]) if ordered else np.empty(0, np.int64)


def count_tables(asked: DataFrame, name: str) -> DataFrame:
    """Collection-wide totals for each chunk: ``chunk`` and the answers in column ``name``.

    Count tables are partitioned by hash; each is summed up in one task and
    holds an entry per chunk and hash at most, however frequent the hash is.
    """
    told = store(asked.groupBy("bucket").applyInPandas(tell_rows, TOLD), name)
    return told.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "totals")).alias(name))


def chunks(frames: Iterable[pd.DataFrame], sizes, most: int) -> Iterator[pd.DataFrame]:
    """Frames of consecutive rows of about ``most`` bytes (a longer row stands alone).

    ``sizes`` gives the byte sizes of a frame's rows. Several small frames
    make one chunk; nothing is dropped.
    """
    held: list[pd.DataFrame] = []
    total = 0
    for frame in frames:
        if not len(frame):
            continue
        ends = np.cumsum(sizes(frame))
        start, before = 0, 0
        while start < len(frame):
            stop = max(int(np.searchsorted(ends, before + most - total, "right")), start + (not held))
            if stop > start:
                held.append(frame.iloc[start:stop])
                total += int(ends[stop - 1] - before)
                start, before = stop, int(ends[stop - 1])
            if start < len(frame):
                yield pd.concat(held, ignore_index=True)
                held, total = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def byte_sizes(column: str):
    """Approximate byte sizes of a string column; null counts as one."""
    return lambda frame: frame[column].str.len().fillna(1).to_numpy(np.int64) + 1


def wrapped(docs: DataFrame, *others) -> DataFrame:
    """``docs`` as one struct column ``_doc`` beside ``others``: whatever its columns are called, none can clash."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"), *others)


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder.

    Later stages read the table, not its history: a lost executor costs the
    tasks it ran, and what a task derived from its partition number stays as
    it was first written. ``storage.temporary_copies`` deletes the tables made inside it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    copies.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
