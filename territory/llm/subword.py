"""Linear softmax over averaged hashed subword embeddings, trained by SGD in numpy.

A text is the average of learned vectors of its hashed words and character
n-grams. As the softmax layer is linear, a bucket's vector times that layer
is that bucket's score, so a worker needs one small table to read any text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from territory.llm.blocks import U64, mix, pack, pack_sorted, text_batches, unpack, unpack_sorted

#: Bytes that are hashed at a time; a longer text is read in stretches that end at white space.
STRETCH_BYTES = 1 << 20
#: Updates that a small sample is repeated for.
LEAST_STEPS = 5000
#: Buckets of the sampling hash.
SAMPLE_BUCKETS = 1 << 20

#: Fixed value: bytes between words.
BLANK_BYTES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
STEP = U64(0x5851F42D4C957F2D | 1)


@dataclass(frozen=True)
class Features:
    """Which parts of a text are hashed, and into how many buckets."""

    grams: tuple[int, ...] = (3, 4)
    words: bool = True
    repeats: bool = False
    lower: bool = False
    bits: int = 16


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.append(np.ones(1, U64), np.full(n - 1, base, U64)), dtype=U64)


_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """A random value per byte, powers of the step and of its inverse."""
    if not _TABLES:
        inverse = pow(int(STEP), -1, 1 << 64)
        _TABLES.extend([mix(np.arange(1, 257, dtype=U64)), _powers(int(STEP), STRETCH_BYTES + 1), _powers(inverse, STRETCH_BYTES + 1)])
    return _TABLES


def word_sums(data: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums that hash the maximal runs of bytes that are not blank, in order (at most a stretch long), and their lengths."""
    values, up, down = _tables()
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    total = np.append(U64(0), np.cumsum(values[data] * up[: len(data)], dtype=U64))
    return (total[ends] - total[starts]) * down[starts], ends - starts


def word_hashes(data: np.ndarray, blank: np.ndarray) -> np.ndarray:
    """Hashes of the words of a stretch."""
    return mix(word_sums(data, blank)[0])


def long_word_hashes(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Hashes of the words of a text in stretches; a word may go over any number of them."""
    out, begun, length = [], np.empty(0, U64), 0  # the sum of a word that may go on, and its bytes so far
    for data, blank in parts:
        sums, sizes = word_sums(data, blank)
        if length and blank[0]:
            out.append(begun)
            length = 0
        if length:
            sums[:1] = begun + sums[:1] * np.array([pow(int(STEP), length, 1 << 64)], U64)
        if blank[-1]:
            out.append(sums)
            length = 0
        else:
            out.append(sums[:-1])
            begun, length = sums[-1:], int(sizes[-1]) + (length if len(sums) == 1 else 0)
    if length:
        out.append(begun)
    return mix(np.concatenate(out)) if out else np.empty(0, U64)


def stretches(data: bytes) -> Iterator[np.ndarray]:
    """A text's bytes in parts of at most ``STRETCH_BYTES``, cut after white space where there is any."""
    start = 0
    while len(data) - start > STRETCH_BYTES:
        end = start + STRETCH_BYTES
        cut = max(data.rfind(b, start + 1, end) for b in BLANK_BYTES) + 1 or end
        yield np.frombuffer(data, np.uint8, cut - start, start)
        start = cut
    if start < len(data):
        yield np.frombuffer(data, np.uint8, offset=start)


def feature_ids(data: np.ndarray, what: Features) -> np.ndarray:
    """Buckets of every feature of a stretch of bytes."""
    if what.lower:
        data = LOWER[data]
    out, shift = [], np.uint32(32 - what.bits)
    wide = data.astype(np.uint32)
    for size in what.grams:
        n = len(data) - size + 1
        if n > 0:
            h = np.full(n, size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for j in range(size):
                h = (h ^ wide[j : j + n]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
            out.append((h * np.uint32(0x85EBCA6B)) >> shift)
    if what.words or what.repeats:
        words = word_hashes(data, data <= 32)
        if what.words:
            out.append((words >> U64(64 - what.bits)).astype(np.uint32))
        if what.repeats:  # one shared feature per word that stands among the two before it
            same = np.zeros(len(words), bool)
            same[1:] = words[1:] == words[:-1]
            same[2:] |= words[2:] == words[:-2]
            out.append(np.full(int(same.sum()), (1 << what.bits) - 1, np.uint32))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def bag(text: str | None, what: Features) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their counts."""
    parts = [feature_ids(part, what) for part in stretches((text or "").encode("utf-8", "surrogatepass"))]
    ids, counts = np.unique(np.concatenate(parts) if parts else np.empty(0, np.uint32), return_counts=True)
    return ids, counts


@dataclass
class Model:
    """Scores per bucket and class; ``heat`` divides them (calibration)."""

    what: Features
    classes: list
    scores: np.ndarray
    bias: np.ndarray
    heat: float = 1.0
    floor: float = 0.0
    facts: dict = field(default_factory=dict)

    def logits(self, text: str | None) -> np.ndarray:
        total, n = np.zeros(len(self.classes)), 0
        for part in stretches((text or "").encode("utf-8", "surrogatepass")):
            ids = feature_ids(part, self.what)
            for k in range(len(self.classes)):
                total[k] += self.scores[k].take(ids).sum(dtype=np.float64)
            n += len(ids)
        return total / max(n, 1) + self.bias

    def probabilities(self, text: str | None) -> np.ndarray:
        return softmax(self.logits(text) / self.heat)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def labelled_bags(rows: DataFrame, label: Column, key: Column, text_col: str, what: Features, most: int) -> list:
    """A bounded sample of labelled rows as packed bags: [(label, buckets, counts)].

    About ``most`` rows with a label are taken, chosen by a hash of ``key``;
    fewer rows are all taken. Bags are made on the executors and stay packed
    (some kilobytes each) until a training step opens one.
    """
    spot = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(SAMPLE_BUCKETS))
    known = rows.filter(label.isNotNull())
    n = known.count()
    if not n:
        return []
    taken = known.filter(spot < F.lit(min(SAMPLE_BUCKETS, -(-SAMPLE_BUCKETS * most // n))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bags = [bag(t if isinstance(t, str) else None, what) for t in frame["text"]]
            yield pd.DataFrame(
                {
                    "label": frame["label"],
                    "spot": frame["spot"],
                    "ids": [pack_sorted(b[0]) for b in bags],
                    "counts": [pack(b[1].astype(np.uint32)) for b in bags],
                }
            )

    text_batches(rows.sparkSession)
    made = taken.select(label.cast("string").alias("label"), spot.alias("spot"), F.col(text_col).alias("text"))
    bags = made.mapInPandas(run, "label string, spot long, ids binary, counts binary").collect()
    bags.sort(key=lambda r: (r["spot"], r["label"], bytes(r["ids"])))
    return [(r["label"], bytes(r["ids"]), bytes(r["counts"])) for r in bags]


def _opened(bag: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a packed bag and their shares of it."""
    counts = unpack(bag[2], np.uint32).astype(np.float32)
    return unpack_sorted(bag[1], np.uint32), counts / max(counts.sum(), 1)


def train(
    bags: list,
    what: Features,
    classes: list[str],
    size: int = 16,
    epochs: int = 6,
    rate: float = 0.5,
    held_back: float = 0.2,
    seed: int = 7,
) -> Model:
    """Fit vectors and softmax by SGD, then a temperature on rows held back.

    With no rows, or rows of one class, the model gives the smoothed shares of
    the classes for every text.
    """
    rng = np.random.default_rng(seed)
    at = {c: k for k, c in enumerate(classes)}
    kept = [bag for bag in bags if len(_opened(bag)[0])]
    split = int(len(kept) * (1 - held_back)) if len(kept) >= 50 else len(kept)
    order = rng.permutation(len(kept))
    fit, rest = [kept[i] for i in order[:split]], [kept[i] for i in order[split:]]
    share = np.array([1.0 + sum(label == c for label, _, _ in bags) for c in classes])
    prior = np.log(share / share.sum())
    vectors = rng.uniform(-1 / size, 1 / size, (1 << what.bits, size)).astype(np.float32)
    layer, bias = np.zeros((size, len(classes)), np.float32), prior.astype(np.float32)
    seen = np.zeros(1 << what.bits, bool)
    for bag in fit:
        seen[_opened(bag)[0]] = True
    epochs = max(epochs, -(-LEAST_STEPS // max(len(fit), 1)))
    steps, done = epochs * max(len(fit), 1), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            label = at[fit[i][0]]
            ids, share_of = _opened(fit[i])
            part = vectors[ids]
            mean = share_of @ part
            error = softmax(mean @ layer + bias)
            error[label] -= 1
            now = rate * (1 - done / steps)
            back = layer @ error
            layer -= now * np.outer(mean, error)
            bias -= 0.02 * now * error
            vectors[ids] = part - (now * len(ids) ** 0.5) * np.outer(share_of, back)
            done += 1
    vectors[~seen] = 0
    model = Model(what, classes, np.ascontiguousarray((vectors @ layer).T), bias.astype(np.float64))
    if rest:
        opened = map(_opened, rest)
        logits = np.array([(model.scores[:, ids] * n).sum(axis=1) + bias for ids, n in opened], np.float64)
        truth = np.array([at[label] for label, _, _ in rest])
        heats = np.geomspace(0.2, 5, 41)
        loss = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in heats]
        model.heat = float(heats[int(np.argmin(loss))])
        sure = softmax(logits / model.heat)
        model.facts = {
            "rows": len(kept),
            "held_back": len(rest),
            "accuracy": float((sure.argmax(axis=1) == truth).mean()),
            "sure": np.sort(sure.max(axis=1)),
            "right": (sure.argmax(axis=1) == truth)[np.argsort(sure.max(axis=1))],
        }
    return model


def rejection_floor(model: Model, precision: float) -> float:
    """Smallest confidence from which held-back rows are right with ``precision``."""
    right = model.facts.get("right")
    if right is None or not len(right):
        return 0.0
    share = np.cumsum(right[::-1])[::-1] / np.arange(len(right), 0, -1)
    good = np.flatnonzero(share >= precision)
    return float(model.facts["sure"][good[0]]) if len(good) else 1.0
