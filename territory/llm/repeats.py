"""Deleting long repeated byte strings with longest-previous-factor arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
earlier in the collection. Suffixes of the whole collection need not be sorted
in one order: equal strings choose the same anchor (the smallest hash among
the ``GRAM``-byte grams inside, the leftmost if several), so suffixes are only
compared with those that share their anchor's gram.

1. A chunk of documents finds its anchors. An anchor owns a run of consecutive
   windows (strings of ``LENGTH`` bytes); the bytes of that run are its
   context. One row per chunk and bucket carries them as arrays; a context
   that repeats in the chunk is sent once, its later copies are settled there.
2. In a bucket of gram hashes, later copies of an equal context are settled.
   What is left to compare are different contexts around the same gram.
3. Their bytes are fetched and put in suffix order by prefix doubling. In that
   order the previous and the next smaller position of a suffix hold its
   longest previous factor; a window whose factor reaches ``LENGTH`` goes.

A gram with very many different contexts would make a hot group in step 3;
its windows are dealt out one by one by a hash of their whole content instead,
so nothing is left out and no group is unbounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from territory.llm.blocks import (
    U64,
    bucket_bounds,
    buckets_of,
    byte_sizes,
    chunks,
    join_hashes,
    mix,
    pack,
    pack_sorted,
    store,
    text_batches,
    unpack,
    unpack_sorted,
    wrapped,
)

LENGTH = 100
GRAM = 32
CHUNK_BYTES = 4 << 20
#: Bytes of contexts that a task gathers before it hands them on.
FETCH_BYTES = 4 << 20
#: Windows that are hashed at a time.
STRETCH = 1 << 17
#: Buckets of gram hashes per shuffle partition, in step 2 and in step 3: a bucket is one
#: group in memory, and ranking takes some 100 bytes for each byte of context.
ANCHOR_BUCKETS, CONTEXT_BUCKETS = 4, 48
#: Different contexts of one gram beyond which its windows are dealt out one by one.
SPREAD_OVER = 3_000
#: A null id comes after all others.
LAST_ID = (1 << 63) - 1

BYTE_HASH = mix(np.arange(1, 257, dtype=U64))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * U64(0x9FB21C651E98DF25)
    out ^= out >> U64(32)
    out += b
    out *= U64(0xD6E8FEB86659FD93)
    out ^= out >> U64(29)
    return out


def gram_hashes(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """Hashes of all runs of ``sizes`` bytes, one array per size, by doubling."""
    level, made, most = BYTE_HASH[data], {}, max(sizes)
    at = {size: (None, 0) for size in sizes}
    width = 1
    while width <= most:
        for size, (so_far, done) in at.items():
            if size & width:  # the next binary digit of the size
                n = len(data) - size + 1
                part = level[done : done + n]
                at[size] = (part if so_far is None else combine(so_far, part), done + width)
        if width * 2 > most or len(level) <= width:
            break
        level = combine(level[:-width], level[width:])
        width *= 2
    for size in sizes:
        made[size] = at[size][0]
    return [made[size] for size in sizes]


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value in each run of ``width`` values."""
    low, at, span = values, np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        right = low[step:] < low[:-step]
        at = np.where(right, at[step:], at[:-step])
        low = np.where(right, low[step:], low[:-step])
        span += step
    return at


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of a text's windows: gram hash, context hash, first and last window.

    Long texts are worked through in stretches of windows; a context that a
    stretch cuts is two contexts, which only means more to compare.
    """
    parts = []
    for start in range(0, len(data) - length + 1, STRETCH):
        piece = data[start : start + STRETCH + length - 1]
        grams, whole = gram_hashes(piece, gram, length)
        at = leftmost_minima(grams, length - gram + 1)
        edge = np.flatnonzero(np.diff(at, prepend=-1))
        last = np.append(edge[1:], len(at)) - 1
        spot = at[edge]
        context = join_hashes(whole[edge], whole[last], (last - edge).astype(U64), (spot - edge).astype(U64))
        # An anchor is a minimum, so anchors crowd at the low end; mixed once more they spread evenly over ranges.
        parts.append((mix(grams[spot]), context, edge + start, last + start))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else ()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    return [id_.alias("id"), F.xxhash64(text).alias("key"), F.encode(text, "UTF-8").alias("data")]


ROWS = "bucket int, id binary, key binary, first binary, more binary, gram binary, context binary"
FOUND = "id long, key long, first int, last int, gram long, spread boolean"
CONTEXTS = "bucket int, id binary, key binary, first binary, size binary, data binary"
RUNS = "id long, key long, first int, last int"


def settle(grams, context, *place) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts in order of gram, hash and place (id, key, first window).

    Gives the order, and for the rows in it: whether the row is the first of
    its context, and whether it is a later copy. A row at the very place of
    the first one (its document is repeated whole, with its id) is neither.
    """
    id_, key, first = place
    order = np.lexsort((first, key, id_, context, grams))
    g, c = grams[order], context[order]
    head = np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1]))
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = np.zeros(len(order), bool)
    for part in place:
        later |= part[order] != part[order[lead]]
    return order, head, later


def _chunk_rows(frames: Iterator[pd.DataFrame], length: int, gram: int, buckets: int) -> Iterator[pd.DataFrame]:
    """Step 1: anchors of a chunk, an array row per bucket; copies inside the chunk in rows of bucket -1."""
    for frame in chunks(frames, byte_sizes("data"), CHUNK_BYTES):
        found = []
        for id_, key, data in zip(frame["id"], frame["key"], frame["data"], strict=True):
            made = anchors(np.frombuffer(data, np.uint8), length, gram)
            if made:
                found.append((np.full(len(made[0]), id_, np.int64), np.full(len(made[0]), key, np.int64), *made))
        if not found:
            continue
        id_, key, grams, context, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
        first, last = first.astype(np.int32), last.astype(np.int32)
        order, head, later = settle(grams, context, id_, key, first)
        copies, heads = order[later], order[head]
        if len(copies):
            yield _row(-1, *(x[copies] for x in (id_, key, first, last)), None, None)
        bounds = bucket_bounds(grams[heads], buckets)
        rows = [
            _row(b, *(x[heads[lo:hi]] for x in (id_, key, first, last, grams, context)))
            for b, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
            if hi > lo
        ]
        if rows:
            yield pd.concat(rows, ignore_index=True)


def _row(bucket: int, id_, key, first, last, gram, context) -> pd.DataFrame:
    more = pack((last - first).astype(np.int32))
    return pd.DataFrame(
        {
            "bucket": [bucket],
            "id": [pack(id_)],
            "key": [pack(key)],
            "first": [pack(first)],
            "more": [more],
            "gram": [None if gram is None else pack_sorted(gram)],
            "context": [None if context is None else pack(context)],
        }
    )


def _open(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    id_ = np.concatenate([unpack(x, np.int64) for x in frame["id"]])
    key = np.concatenate([unpack(x, np.int64) for x in frame["key"]])
    first = np.concatenate([unpack(x, np.int32) for x in frame["first"]])
    last = first + np.concatenate([unpack(x, np.int32) for x in frame["more"]])
    return id_, key, first, last


def _touching(id_, key, first, last, length: int) -> pd.DataFrame:
    """Runs of windows, joined where the bytes they cover touch: first and last window of each."""
    order = np.lexsort((first, key, id_))
    id_, key, first, last = id_[order], key[order], first[order], last[order]
    if not len(order):
        return pd.DataFrame({"id": id_, "key": key, "first": first, "last": last})
    new = np.append(True, (id_[1:] != id_[:-1]) | (key[1:] != key[:-1]) | (first[1:] > last[:-1] + length))
    at = np.flatnonzero(new)
    return pd.DataFrame({"id": id_[at], "key": key[at], "first": first[at], "last": np.maximum.reduceat(last, at)})


def _bucket(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Step 2: settled runs (gram null) and contexts that are still to be compared."""
    id_, key, first, last = _open(frame)
    if frame["bucket"].iloc[0] < 0:
        out = _touching(id_, key, first, last, length)
        return out.assign(gram=pd.array([None] * len(out), "Int64"), spread=False)
    grams = np.concatenate([unpack_sorted(x) for x in frame["gram"]])
    context = np.concatenate([unpack(x, U64) for x in frame["context"]])
    order, head, later = settle(grams, context, id_, key, first)
    copies, heads = order[later], order[head]
    settled = _touching(id_[copies], key[copies], first[copies], last[copies], length)
    settled = settled.assign(gram=pd.array([None] * len(settled), "Int64"), spread=False)
    g = grams[heads]
    _, inverse, counts = np.unique(g, return_inverse=True, return_counts=True)
    several = counts[inverse]
    heads, g, several = heads[several > 1], g[several > 1], several[several > 1]
    open_ = pd.DataFrame(
        {
            "id": id_[heads],
            "key": key[heads],
            "first": first[heads],
            "last": last[heads],
            "gram": pd.array(g.view(np.int64), "Int64"),
            "spread": several > SPREAD_OVER,
        }
    )
    return pd.concat([settled, open_], ignore_index=True)


def _fetch(frames: Iterator[pd.DataFrame], length: int, buckets: int) -> Iterator[pd.DataFrame]:
    """Step 3a: the bytes of open contexts, an array row per bucket and some megabytes of them."""
    held, total = [], 0
    for frame in frames:
        for i, k, data, wanted in frame[["id", "key", "data", "wanted"]].itertuples(index=False, name=None):
            for w in wanted:
                if w["spread"]:
                    for s in range(w["first"], w["last"] + 1):
                        text = data[s : s + length]
                        spot = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big")
                        held.append((spot * buckets >> 64, i, k, s, text, True))
                else:
                    text = data[w["first"] : w["last"] + length]
                    held.append(((w["gram"] & ((1 << 64) - 1)) * buckets >> 64, i, k, w["first"], text, False))
                total += (w["last"] - w["first"] + 1) * length if w["spread"] else len(text)
                if total > FETCH_BYTES:
                    yield _context_rows(held)
                    held, total = [], 0
    if held:
        yield _context_rows(held)


def _context_rows(held: list[tuple]) -> pd.DataFrame:
    """Rows of contexts per bucket. Of equal windows that are dealt out alone only the first
    is sent on; the others are settled here, in a row of bucket -1 without bytes."""
    lead: dict[bytes, tuple] = {}
    for _, *place, text, alone in held:
        if alone and tuple(place) < lead.get(text, (np.inf,)):
            lead[text] = tuple(place)
    held = [row if not row[5] or lead[row[4]] == row[1:4] else (-1, *row[1:4], b"", True) for row in held]
    held.sort(key=lambda row: row[0])
    bucket, id_, key, first, texts, _ = zip(*held, strict=True)
    edge = np.append(np.flatnonzero(np.diff(np.array(bucket), prepend=-2)), len(bucket))
    rows = [
        {
            "bucket": bucket[lo],
            "id": pack(np.array(id_[lo:hi], np.int64)),
            "key": pack(np.array(key[lo:hi], np.int64)),
            "first": pack(np.array(first[lo:hi], np.int32)),
            "size": pack(np.array([len(t) for t in texts[lo:hi]], np.int32)),
            "data": pack(np.frombuffer(b"".join(texts[lo:hi]), np.uint8)),
        }
        for lo, hi in zip(edge[:-1], edge[1:], strict=True)
    ]
    return pd.DataFrame(rows)


def dense_ranks(values: np.ndarray) -> np.ndarray:
    """Rank of each value among the distinct values."""
    order = np.argsort(values)
    ranks = np.empty(len(values), U64)
    ordered = values[order]
    ranks[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]), dtype=U64)
    return ranks


def window_ranks(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the strings of ``length`` bytes at ``starts``: prefix doubling from 8 bytes on.

    Equal ranks are equal strings, smaller ranks smaller strings; no hashes.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U64)
    width = 1
    while width * 2 <= min(8, length):  # up to eight bytes as one number
        padded = (padded[:-width] << U64(8 * width)) | padded[width:]
        width *= 2
    ranks = dense_ranks(padded[: len(data)])
    while width * 2 <= length:
        after = np.zeros_like(ranks)
        after[:-width] = ranks[width:]
        ranks = dense_ranks((ranks << U64(32)) | after)
        width *= 2
    rest = length - width
    return dense_ranks((ranks[starts] << U64(32)) | ranks[starts + rest]) if rest else dense_ranks(ranks[starts])


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For each index the nearest one before it with a smaller value, else -1.

    All indices jump at once along the answers found so far.
    """
    at = np.arange(-1, len(values) - 1)
    moving = np.flatnonzero(at >= 0)
    while len(moving):
        moving = moving[values[at[moving]] >= values[moving]]
        at[moving] = at[at[moving]]
        moving = moving[at[moving] >= 0]
    return at


def has_earlier(ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether a suffix's longest previous factor spans the whole ranked string.

    ``places`` orders the text (equal places are one place). In suffix order
    the longest previous factor of a suffix lies at its previous or next
    smaller place; it is long enough if the ranks are equal.
    """
    order = np.lexsort((places, ranks))
    place, rank = places[order], ranks[order]
    n = len(order)
    previous = smaller_before(place)
    following = n - 1 - smaller_before(place[::-1])[::-1]
    long = (previous >= 0) & (rank[previous] == rank)
    long |= (following < n) & (rank[np.minimum(following, n - 1)] == rank)
    out = np.empty(n, bool)
    out[order] = long
    return out


def _compare(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Step 3b: longest previous factors of a bucket's suffixes; runs of windows that go."""
    id_, key = (np.concatenate([unpack(x, np.int64) for x in frame[c]]) for c in ("id", "key"))
    first, size = (np.concatenate([unpack(x, np.int32) for x in frame[c]]).astype(np.int64) for c in ("first", "size"))
    if frame["bucket"].iloc[0] < 0:
        return _touching(id_, key, first, first, length)
    data = np.concatenate([unpack(x, np.uint8) for x in frame["data"]])
    begin = np.cumsum(size) - size
    count = size - length + 1
    owner = np.repeat(np.arange(len(size)), count)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    starts, place = begin[owner] + step, first[owner] + step
    _, document = np.unique(np.rec.fromarrays([id_, key]), return_inverse=True)
    gone = has_earlier(window_ranks(data, starts, length), (document[owner] << 32) + place)
    at = np.flatnonzero(gone)
    return _touching(id_[owner[at]], key[owner[at]], place[at], place[at], length)


def repeated_runs(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Runs of windows that start earlier too: id, key (hash of the text), first and last window.

    The runs of a document may overlap and come in several rows.
    """
    partitions = buckets_of(text_batches(docs.sparkSession))
    buckets, fine = ANCHOR_BUCKETS * partitions, CONTEXT_BUCKETS * partitions
    keyed = docs.select(*_keyed(docs, id_col, text_col))
    rows = keyed.mapInPandas(lambda f: _chunk_rows(f, length, gram, buckets), ROWS)
    # rows of bucket -1 are settled and need not meet: each is a group of its own
    part = F.when(F.col("bucket") < 0, F.xxhash64("id", "key", "first")).otherwise(0)
    found = store(
        rows.withColumn("part", part).groupBy("bucket", "part").applyInPandas(lambda f: _bucket(f, length), FOUND), "repeat-runs"
    )
    settled = found.filter("gram is null").select("id", "key", "first", "last")
    wanted = (
        found.filter("gram is not null")
        .groupBy("id", "key")
        .agg(F.collect_list(F.struct("first", "last", "gram", "spread")).alias("wanted"))
    )
    fetched = keyed.join(wanted, ["id", "key"]).mapInPandas(lambda f: _fetch(f, length, fine), CONTEXTS)
    compared = store(fetched.withColumn("part", part).groupBy("bucket", "part").applyInPandas(lambda f: _compare(f, length), RUNS), "repeat-compared")
    return settled.unionByName(compared)


def mark_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the bytes that stay and counts of what goes.

    New columns (they replace columns of these names): ``kept`` (binary, the
    UTF-8 bytes that stay), ``n_bytes``, ``n_removed`` and ``spans`` (removed
    runs of bytes, start and end exclusive).

    A string starts earlier in a row with a smaller id (null ids last), in a
    row of the same id with a smaller text hash, or further left in the same
    text. A row that repeats both id and text is the same document and gets
    the same result. A null text counts as empty. Texts shorter than
    ``length`` stay as they are. Other columns stay; an empty table gives no rows.
    """
    new = ["kept", "n_bytes", "n_removed", "spans"]
    docs = docs.drop(*new)
    runs = repeated_runs(docs, length, gram, id_col, text_col)
    grouped = runs.groupBy("id", "key").agg(F.collect_list(F.struct("first", "last")).alias("_runs"))
    id_, key, _ = _keyed(docs, id_col, text_col)
    joined = wrapped(docs, id_, key, F.col(text_col).alias("text")).join(grouped, ["id", "key"], "left")

    @F.pandas_udf("kept binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for text, wanted in zip(texts, found, strict=True):
            data = (text or "").encode("utf-8")
            spans: list[list[int]] = []
            for run in sorted((r["first"], r["last"] + length) for r in (wanted if wanted is not None else ())):
                if spans and run[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], run[1])
                else:
                    spans.append(list(run))
            edges = [0, *(x for span in spans for x in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            out.append((kept, len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in spans]))
        return pd.DataFrame(out, columns=new)

    made = joined.withColumn("_made", cut("text", "_runs"))
    return made.select("_doc.*", *(F.col(f"_made.{n}").alias(n) for n in new))
