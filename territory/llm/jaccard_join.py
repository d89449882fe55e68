"""N-gram Jaccard join by grouped prefixes.

A document is the set of its shingles. Two sets of a similarity of at least t
share a shingle among their rarest |s| - ceil(t |s|) + 1, their prefix.

1. Documents with equal sets are one class; only classes are compared.
2. Shingles in a quarter of the hash space are counted over the collection and
   ordered by that count, the others follow by hash: an order as good as any,
   and a prefix that consists of shingles found nowhere else needs no partner.
3. Classes with the same prefix and size are one group. Groups that share a
   prefix shingle and may reach the similarity by their sizes are candidates.
4. In a block (a shared shingle and a range of sizes) every group is compared
   with the block's lead, the group whose parity bits (below) are nearest to a few
   others of the block: the copy with the fewest changes. Every member is compared
   with its group's first. Links found make components, and pairs inside one component
   need no look. Blocks of several components do so once more, with a lead from
   outside their largest one.
5. In the blocks that still hold several components the groups outside the
   block's largest component meet all others; groups expand to their members, the
   smaller one first, and the sets of what is left are compared.

Before sets are fetched, every pair passes a bound: bits that hold the parity of
the shingles that fall on them differ at most as often as the sets do. Pairs of
groups pass it by the bits that all members of either group agree on.

Step 4 keeps a block of thousands of near copies from making all its pairs: what
is left for step 5 are the few classes that its first ones do not reach.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from territory.llm.blocks import (
    ASKED,
    U64,
    ask_rows,
    buckets_of,
    byte_sizes,
    chunks,
    count_tables,
    forget,
    join_hashes,
    mix,
    pack,
    pack_sorted,
    store,
    text_batches,
    totals_of,
    unpack,
    unpack_sorted,
    wrapped,
)
from territory.llm.components import components
from territory.llm.lm_score import words_of

SHINGLE_WORDS = 3
#: A pair is made at its first common token, as far as this many tokens tell; beyond them repeats are dropped later.
FIRST_TOKENS = 16
#: Similarity in hundredths.
LEAST = 90
CHUNK_BYTES = 4 << 20
#: Shingle hashes below this are counted for the order.
COUNTED = U64(1 << 62)
#: Bits of the parity bound, as columns of 64.
BITS = tuple(f"b{k}" for k in range(8))
#: For each column of a group the bits that its members do not agree on.
LOOSE = tuple(f"loose_{b}" for b in BITS)
#: Groups of a block by which its lead is found.
SAMPLED = 8
#: A word's first character, as ``words_of`` reads it.
WORD = r"[^\x20\x09-\x0D]"
#: A null id comes after all others.
LAST_ID = (1 << 63) - 1

SKETCH = "chunk long, ids array<long>, keys binary, sizes binary, marks binary, heads binary, bits binary, lengths binary, grams binary"
MEMBERS = "id long, key long, n long, x binary"
PREFIXES = ", ".join(["x binary, n long, id long, key long, g binary, tokens array<long>", *(f"{b} long" for b in BITS)])


def shingles(text: str | None, size: int) -> np.ndarray:
    """Ascending distinct hashes of the runs of ``size`` words; fewer words are one run, none gives none."""
    words = words_of(text)
    if not len(words):
        return np.empty(0, U64)
    size = min(size, len(words))
    return np.unique(join_hashes(*(words[k : len(words) - size + 1 + k] for k in range(size))))


def mark(grams: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return np.array([mix(grams).sum(dtype=U64), mix(grams ^ U64(0xA5A5A5A55A5A5A5A)).sum(dtype=U64) + U64(len(grams))], U64).tobytes()


def parities(grams: np.ndarray) -> np.ndarray:
    """For each of the bits whether an odd number of shingles falls on it, as 64-bit numbers."""
    width = 64 * len(BITS)
    odd = np.bincount((mix(grams) & U64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix_size(n, least: int):
    """Length of the prefix of a set of ``n`` shingles."""
    return n - -(-least * n // 100) + 1


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(text).alias("key"),
        text.alias("text"),
    ]


def _sketches(frames: Iterator[pd.DataFrame], size: int, least: int) -> Iterator[pd.DataFrame]:
    """Steps 1 and 2: sizes and marks of a chunk's sets; of its classes, the shingles a prefix can come from."""
    forget()
    chunk = TaskContext.get().partitionId() << 32
    for frame in chunks(frames, byte_sizes("text"), CHUNK_BYTES):
        sizes, marks, heads, bits, lengths, parts, seen = [], [], [], [], [], [], set()
        for i, text in enumerate(frame["text"]):
            grams = shingles(text, size)
            sizes.append(len(grams))
            marks.append(mark(grams))
            if len(grams) and marks[-1] not in seen:
                seen.add(marks[-1])
                counted = int(np.searchsorted(grams, COUNTED))
                take = max(counted, prefix_size(len(grams), least))  # in order of hash, so the counted ones come first
                heads.append(i)
                bits.append(parities(grams))
                lengths.append(take)
                parts.append(grams[:take])
        yield pd.DataFrame(
            {
                "chunk": [chunk],
                "ids": [frame["id"].tolist()],
                "keys": [pack(frame["key"].to_numpy(np.int64))],
                "sizes": [pack(np.array(sizes, np.int64))],
                "marks": [b"".join(marks)],
                "heads": [pack(np.array(heads, np.int32))],
                "bits": [b"".join(b.tobytes() for b in bits)],
                "lengths": [pack(np.array(lengths, np.int32))],
                "grams": [pack(np.concatenate(parts) if parts else np.empty(0, U64))],
            }
        )
        chunk += 1


def _members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples(index=False):
            sizes = unpack(row.sizes, np.int64)
            marks = [row.marks[i : i + 16] if n else None for i, n in zip(range(0, len(row.marks), 16), sizes, strict=True)]
            yield pd.DataFrame({"id": row.ids, "key": unpack(row.keys, np.int64), "n": sizes, "x": marks})


def _prefixes(frames: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Step 3: prefixes of a chunk's classes that hold a shingle found elsewhere too."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            grams, lengths = unpack(row.grams, U64), unpack(row.lengths, np.int32)
            heads, sizes, keys = unpack(row.heads, np.int32), unpack(row.sizes, np.int64), unpack(row.keys, np.int64)
            distinct, inverse = np.unique(mix(grams), return_inverse=True)
            counts = totals_of(row.shingle_counts)[inverse]
            free = grams >= COUNTED
            order_count = np.where(free, np.iinfo(np.int64).max, counts)
            out, start = [], 0
            bits = np.frombuffer(row.bits, np.int64).reshape(-1, len(BITS)).tolist()
            for head, length, own in zip(heads.tolist(), lengths.tolist(), bits, strict=True):
                n = int(sizes[head])
                mine = slice(start, start + length)
                start += length
                order = np.lexsort((grams[mine], order_count[mine]))[: prefix_size(n, least)]
                prefix = grams[mine][order]
                shared = prefix[counts[mine][order] > 1]
                if len(shared):
                    group = mark(np.append(prefix, U64(n)))
                    x = row.marks[16 * head : 16 * head + 16]
                    out.append((x, n, row.ids[head], keys[head], group, shared.view(np.int64).tolist(), *own))
            yield pd.DataFrame(out, columns=["x", "n", "id", "key", "g", "tokens", *BITS])


def _sets(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The whole set of each class."""
    for frame in frames:
        yield pd.DataFrame({"x": frame["x"], "grams": [pack_sorted(shingles(text, size)) for text in frame["text"]]})


def linked(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Whether two ascending sets reach the similarity."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= least * (len(a) + len(b) - common)


def _verify(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) whose sets reach the similarity, stored."""
    left = sets.select(F.col("x").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("x").alias("b"), F.col("grams").alias("gb"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            known: dict[bytes, np.ndarray] = {}
            good = []
            for a, b, ga, gb in frame[["a", "b", "ga", "gb"]].itertuples(index=False, name=None):
                if len(known) > 500:
                    known.clear()
                for x, g in ((a, ga), (b, gb)):
                    if x not in known:
                        known[x] = unpack_sorted(g)
                if linked(known[a], known[b], least):
                    good.append((a, b))
            yield pd.DataFrame(good, columns=["a", "b"])

    paired = pairs.join(left, "a").join(right, "b")
    return store(paired.mapInPandas(run, "a binary, b binary"), "jaccard-links")


def _hopeful(one: str, other: str, least: int, groups: bool = False) -> Column:
    """Whether sizes and parity bits of two rows allow the similarity; names are prefixed by either string.

    For two groups: whether any member of the one may reach any of the other.
    """
    n, m = F.col(f"{one}n"), F.col(f"{other}n")
    differ = [F.col(one + b).bitwiseXOR(F.col(other + b)) for b in BITS]
    if groups:
        loose = [F.col(one + b).bitwiseOR(F.col(other + b)) for b in LOOSE]
        differ = [d.bitwiseAND(F.bitwise_not(v)) for d, v in zip(differ, loose, strict=True)]
    apart = reduce(operator.add, map(F.bit_count, differ))
    common = F.shiftright(n + m - apart, 1)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * least) & (common * 100 >= (n + m - common) * least)


def _leads(rows: DataFrame, keys: list[str], least: int, more: tuple[str, ...] = ()) -> DataFrame:
    """The lead of each block: ``keys``, and its x, n, bits and ``more``, prefixed by l.

    That is the row with the fewest differing bits, added up over one row of each of ``SAMPLED`` hash shares of its
    block. Rows much too far for a link count as equally far. It is a choice only: what a lead misses is compared later.
    """
    share = lambda k: F.pmod(F.xxhash64("x"), F.lit(SAMPLED)) == k
    bits = F.struct(F.xxhash64("x", F.lit(1)).alias("order"), *BITS)
    some = rows.groupBy(*keys).agg(
        *[F.min(F.when(share(k), bits)).alias(f"s{k}") for k in range(SAMPLED)], F.min("x").alias("low"), F.max("x").alias("high")
    )
    some = some.filter("low <> high").drop("low", "high")
    beyond = F.col("n") * 8 * (100 - least) / (100 + least)
    apart = lambda s: reduce(operator.add, [F.bit_count(F.col(b).bitwiseXOR(s[b])) for b in BITS])
    far = reduce(operator.add, [F.coalesce(F.least(apart(F.col(f"s{k}")), beyond), F.lit(0.0)) for k in range(SAMPLED)])
    kept = (*more, "x", "n", *BITS)
    lead = rows.join(some, keys).withColumn("far", far).groupBy(*keys).agg(F.min(F.struct("far", "x", *[c for c in kept if c != "x"])).alias("lead"))
    return lead.select(*keys, *[F.col(f"lead.{c}").alias(f"l{c}") for c in kept])


def similarity_classes(
    docs: DataFrame,
    least: int = LEAST,
    size: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Set size and component of every row: the id, ``n_shingles``, ``component_id``.

    A row's set are the distinct runs of ``size`` words (ASCII white space
    between words, A-Z lowered); a text of fewer words is one run; without
    words the set is empty and linked with nothing. Rows are linked if the
    shared shingles are at least ``least`` hundredths of all shingles of both;
    ``component_id`` is the smallest id reachable by links, the own included.

    Ids are integers or null: a row with a null id takes part, is the largest
    id and gets null where no other is reachable. Rows that repeat an id or
    a text are rows of their own. An empty table gives no rows; other columns
    are ignored. Shingles are 64-bit hashes, equal sets share 128 bits.
    """
    members, named = _named_classes(docs, least, size, id_col, text_col)
    return _with_components(members, named, docs, id_col)


def _named_classes(docs: DataFrame, least: int, size: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows with their class, and the classes with their first row (id, key) and component's label."""
    buckets = buckets_of(text_batches(docs.sparkSession))
    keyed = docs.select(*_keyed(docs, id_col, text_col))
    sketch = store(keyed.mapInPandas(lambda f: _sketches(f, size, least), SKETCH), "jaccard-sketch")
    members = sketch.select("ids", "keys", "sizes", "marks").mapInPandas(_members, MEMBERS)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                grams, counts = np.unique(mix(unpack(row.grams, U64)), return_counts=True)
                yield ask_rows(row.chunk, grams, counts, buckets)

    counts = count_tables(sketch.select("chunk", "grams").mapInPandas(ask, ASKED), "shingle_counts")
    prefixes = sketch.join(counts, "chunk").mapInPandas(lambda f: _prefixes(f, least), PREFIXES)
    classes = store(
        prefixes.groupBy("x").agg(
            F.min(F.struct("id", "key")).alias("at"), *[F.first(c).alias(c) for c in ("n", "g", "tokens", *BITS)]
        ),
        "jaccard-classes",
    )
    groups = classes.groupBy("g").agg(
        F.min(F.struct("x", *BITS)).alias("head"),
        F.count(F.lit(1)).alias("m"),
        F.first("n").alias("n"),
        F.first("tokens").alias("tokens"),
        *[F.bit_or(b).bitwiseXOR(F.bit_and(b)).alias(v) for b, v in zip(BITS, LOOSE, strict=True)],
    )
    groups = store(
        groups.select("g", F.monotonically_increasing_id().alias("gid"), "m", "n", "head.*", *LOOSE, "tokens"), "jaccard-groups"
    )
    classes = store(classes.drop("tokens").join(groups.select("g", "gid"), "g").drop("g"), "jaccard-members")
    # ``before``: the rarest of the tokens that precede this one in the order that all groups share
    placed = groups.select("gid", "tokens", F.posexplode("tokens").alias("place", "token"))
    entries = placed.select("gid", "token", F.slice("tokens", 1, F.least("place", F.lit(FIRST_TOKENS))).alias("before"))
    alone = entries.groupBy("token").agg(F.min("gid").alias("p"), F.max("gid").alias("q")).filter("p = q").select("token")
    entries = store(entries.join(alone, "token", "left_anti"), "jaccard-entries")
    groups = store(
        groups.drop("g", "tokens").join(entries.select("gid").distinct().withColumn("open", F.lit(True)), "gid", "left"),
        "jaccard-groups",
    )

    def fetch(pairs: DataFrame) -> DataFrame:
        """Sets of the classes in pairs."""
        wanted = pairs.select(F.col("a").alias("x")).union(pairs.select("b")).distinct()
        at = classes.join(wanted, "x").select("x", F.col("at.id").alias("id"), F.col("at.key").alias("key"))
        texts = keyed.join(at, ["id", "key"]).dropDuplicates(["id", "key"])  # rows repeated whole
        return store(texts.mapInPandas(lambda f: _sets(f, size), "x binary, grams binary"), "jaccard-sets")

    # step 4: members with their group's first, groups with their block's first
    inside = (
        classes.join(groups.filter("m > 1").select("gid", F.col("x").alias("b"), *[F.col(c).alias(f"h{c}") for c in ("n", *BITS)]), "gid")
        .filter((F.col("x") != F.col("b")) & _hopeful("", "h", least))
        .select(F.col("x").alias("a"), "b")
    )
    blocks = entries.drop("before").join(groups.filter("open").drop("m", "open", *LOOSE), "gid")
    first = [inside]
    for shift in (0.0, 0.5):  # ranges of sizes that overlap by a half
        banded = blocks.withColumn("band", F.floor(F.log("n") / np.log(100 / least) + shift))
        first.append(
            banded.join(_leads(banded, ["token", "band"], least), ["token", "band"])
            .filter((F.col("x") != F.col("lx")) & _hopeful("", "l", least))
            .select(F.least("x", "lx").alias("a"), F.greatest("x", "lx").alias("b"))
            .distinct()
        )
    pairs = store(first[0].union(first[1]).union(first[2]).distinct(), "jaccard-pairs")
    links = _verify(pairs, fetch(pairs), least)
    labels = components(links)

    # once more in blocks of several components, with a lead from outside the largest
    named = blocks.join(labels.select(F.col("node").alias("x"), "label"), "x", "left").withColumn(
        "label", F.coalesce("label", "x")
    )
    sizes = named.groupBy("token", "label").agg(F.count(F.lit(1)).alias("size"))
    major = sizes.groupBy("token").agg(F.max(F.struct("size", "label")).alias("most")).select("token", F.col("most.label").alias("major"))
    outside = named.join(major, "token").filter("label <> major").drop("major")
    again = (
        named.join(_leads(outside, ["token"], least, ("label",)), "token")
        .filter((F.col("label") != F.col("llabel")) & _hopeful("", "l", least))
        .select(F.least("x", "lx").alias("a"), F.greatest("x", "lx").alias("b"))
        .distinct()
        .join(pairs, ["a", "b"], "left_anti")
    )
    again = store(again, "jaccard-pairs")
    links = links.unionByName(_verify(again, fetch(again), least))
    pairs = pairs.unionByName(again)
    labels = components(links)

    # step 5: what is left between components of a block
    marked = store(
        classes.join(labels.select(F.col("node").alias("x"), "label"), "x", "left").select(
            "x", "n", "gid", *BITS, F.coalesce("label", "x").alias("label")
        ),
        "jaccard-marked",
    )
    state = marked.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    held = groups.filter("open").select("gid", "m", "n", *BITS, *LOOSE)
    blocks = store(entries.join(held.join(state, "gid"), "gid"), "jaccard-blocks")
    sizes = blocks.filter("low = high").groupBy("token", "low").agg(F.count(F.lit(1)).alias("size"))
    major = sizes.groupBy("token").agg(F.max(F.struct("size", "low")).alias("most")).select("token", F.col("most.low").alias("major"))
    ours = F.coalesce((F.col("low") == F.col("high")) & (F.col("low") == F.col("major")), F.lit(False))
    blocks = blocks.join(major, "token", "left").withColumn("minor", ~ours).drop("major")
    minor = blocks.filter("minor").select(
        "token", *[F.col(c).alias(f"o{c}") for c in ("gid", "m", "n", "low", "high", "before", *BITS, *LOOSE)]
    )
    together = (F.col("low") == F.col("high")) & (F.col("olow") == F.col("ohigh")) & (F.col("low") == F.col("olow"))
    # Two groups meet in every block they share, as one of them is outside its largest component: the first is enough.
    once = ~F.col("minor") | (F.col("gid") < F.col("ogid"))
    earlier = F.arrays_overlap("before", "obefore")  # costs most, so last
    smaller = (F.col("m") < F.col("om")) | ((F.col("m") == F.col("om")) & (F.col("gid") < F.col("ogid")))
    group_pairs = (
        blocks.join(minor, "token")
        .filter(~together & (F.col("gid") != F.col("ogid")) & once & _hopeful("", "o", least, groups=True) & ~earlier)
        .select(F.when(smaller, F.col("gid")).otherwise(F.col("ogid")).alias("g1"), F.when(smaller, F.col("ogid")).otherwise(F.col("gid")).alias("g2"))
    )
    mixed = state.filter("low <> high").select(F.col("gid").alias("g1"), F.col("gid").alias("g2"))
    one = marked.select(F.col("gid").alias("g1"), F.col("x").alias("a"), F.col("label").alias("la"), *[F.col(c).alias(f"p{c}") for c in ("n", *BITS)])
    two = marked.select(F.col("gid").alias("g2"), F.col("x").alias("b"), F.col("label").alias("lb"), *[F.col(c).alias(f"q{c}") for c in ("n", *BITS)])
    expanded = (
        group_pairs.union(mixed).distinct().join(one, "g1").join(two, "g2")
        .filter((F.col("la") != F.col("lb")) & _hopeful("p", "q", least))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    rest = store(expanded.join(pairs, ["a", "b"], "left_anti"), "jaccard-pairs")  # those compared before are not linked
    more = _verify(rest, fetch(rest), least)
    labels = components(links.unionByName(more))

    low = members.filter("x is not null").groupBy("x").agg(F.min(F.struct("id", "key")).alias("low"))
    named = low.join(labels.select(F.col("node").alias("x"), "label"), "x", "left").withColumn("label", F.coalesce("label", "x"))
    return members, store(named, "jaccard-named")


def _with_components(members: DataFrame, named: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    lowest = named.groupBy("label").agg(F.min("low.id").alias("component"))
    per_class = named.join(lowest, "label").select("x", "component")
    real = lambda c: F.when(F.col(c) != LAST_ID, F.col(c)).cast(docs.schema[id_col].dataType)
    out = members.join(per_class, "x", "left").withColumn("component", F.coalesce("component", "id"))
    return out.select(real("id").alias(id_col), F.col("n").alias("n_shingles"), real("component").alias("component_id"))


def keep_first(docs: DataFrame, least: int = LEAST, size: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Null ids come last; of rows with the same id the smallest text hash stays,
    and of rows that repeat id and text any one. Every text without words is a
    component of its own and stays. Columns stay the same.
    """
    _, named = _named_classes(docs, least, size, id_col, text_col)
    stays = named.groupBy("label").agg(F.min("low").alias("low")).select("low.id", "low.key")
    id_, key, text = _keyed(docs, id_col, text_col)
    rows = wrapped(docs, id_, key, text.rlike(WORD).alias("worded"))
    first = rows.filter("worded").join(stays, ["id", "key"], "left_semi").dropDuplicates(["id", "key"])
    return first.select("_doc.*").unionByName(rows.filter("not worded").select("_doc.*"))
