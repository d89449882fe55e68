"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Strict patterns give the base spans, which always stay. Wider patterns propose
further candidates: numbers that a strict match swallowed, spaced, bracketed
or otherwise disguised forms. Labelers (pattern, checksum, gazetteer, context
words, the word before it, borders) vote on every candidate or abstain. Expectation-maximisation
over the counts of vote patterns estimates each labeler's reliability without
any labels; its posteriors train a logistic span classifier on a bounded
sample of candidates, and the classifier decides on the candidates that are
not base spans.

One pass reads the texts and stores the candidates of each row; the rest works
on that small table. Vote patterns are counted by Spark before they reach the
driver, and there are at most 3 to the power of the labelers of each kind.
"""

from __future__ import annotations

import ipaddress
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from territory.llm.blocks import store, text_batches

KINDS = ("email", "ip", "card", "phone")
#: Distinct candidates that train the classifier, about.
SAMPLE_SPANS = 20_000
#: Characters of context that labelers and classifier see on either side.
CONTEXT = 40
HASH_BITS = 12

#: The strict patterns. Possessive runs and the look-behind match
#: the same spans as the plain patterns, without trying every start in a long run.
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

#: Wider patterns.
HIDDEN_EMAIL = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}\s?[\[({]\s?at\s?[\])}]\s?[A-Za-z0-9-]{1,63}"
    r"(?:\s?(?:\.|[\[({]\s?dot\s?[\])}])\s?[A-Za-z0-9-]{1,63}){1,6}",
    re.IGNORECASE,
)
HIDDEN_AT = re.compile(r"[\[({]\s?at\s?[\])}]", re.IGNORECASE)  # a part of every hidden address
HIDDEN_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}){3}(?![0-9])")
LONG_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
CARD_RUN = re.compile(r"(?<![0-9])[0-9]{14,19}(?![0-9])|(?<![0-9])[0-9]{4}(?:[\x20./-][0-9]{4}){3}(?![0-9])")
LOCAL_PHONE = re.compile(
    r"(?<![\w+.])(?:00[1-9][0-9]{0,2}[\x20.-])?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![\w.])"
)

#: Gazetteers. Generic top domains (any two letters are a country's), name parts of hosts in examples and templates.
TOP_DOMAINS = frozenset(
    "aero app arpa biz blog cloud com coop dev edu eco email example gov green health info int jobs live media mil mobi museum name net news "
    "online org page post pro shop site store studio team tech test tel travel web wiki work world xyz".split()
)
#: Leading digits of card numbers by issuer (first, last), with the numbers' lengths.
ISSUERS = (
    (4, 4, (13, 16, 18, 19)), (51, 55, (16,)), (2221, 2720, (16,)), (34, 34, (15,)), (37, 37, (15,)), (6011, 6011, (16, 19)),
    (644, 659, (16, 19)), (3528, 3589, (16, 17, 18, 19)), (300, 305, (14, 16, 19)), (36, 36, (14, 16, 19)), (38, 39, (14, 16, 19)),
    (62, 62, (16, 17, 18, 19)), (50, 50, tuple(range(14, 20))), (56, 58, tuple(range(14, 20))), (60, 60, tuple(range(14, 20))),
    (63, 63, tuple(range(14, 20))), (67, 67, tuple(range(14, 20))), (9792, 9792, (16,)), (2200, 2204, tuple(range(16, 20))),
)
#: Calling codes of one and two digits; beginnings of those of three.
CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
CALLING_STARTS = frozenset("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split())

#: Context words.
NEAR = {
    "email": frozenset("mail email contact write courriel correo kontakt".split()),
    "ip": frozenset("ip host server address adresse login client".split()),
    "card": frozenset("card visa mastercard credit carte tarjeta karte payment".split()),
    "phone": frozenset("call phone tel telephone mobile fax telefon telefono appel".split()),
}
AGAINST = frozenset("version order isbn issn page pages item serial article section ref id".split())
WORD = re.compile(r"[^\W\d_]+")

YES, NO, SILENT = 1, 0, 2
LABELERS = ("pattern", "checksum", "gazetteer", "context", "name", "border")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def base_emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from the at signs: linear in the text."""
    after = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            after = domain.end()
        at = text.find("@", max(at + 1, after))


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """Strict spans (start, end, kind) by start, then kind as listed. Null has none."""
    if not text:
        return []
    found = [(a, b, "email") for a, b in base_emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(int(part[-4:]) <= 255 and len(part.lstrip("0")) <= 3 for part in m.group().split(".")):
                found.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = digits_of(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((*m.span(), "card"))
        for m in PHONE.finditer(text):
            if 10 <= len(digits_of(m.group())) <= 15:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def wider_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates beyond the base spans, none overlapping a base span or each other."""
    found: list[tuple[int, int, str]] = []
    if HIDDEN_AT.search(text):
        found += [(*m.span(), "email") for m in HIDDEN_EMAIL.finditer(text)]
    if DIGIT.search(text):
        if "[.]" in text or "(.)" in text:
            found += [(*m.span(), "ip") for m in HIDDEN_IP.finditer(text)]
        if ":" in text:
            found += [(*m.span(), "ip") for m in LONG_IP.finditer(text)]
        found += [(*m.span(), "card") for m in CARD_RUN.finditer(text)]
        found += [(*m.span(), "phone") for m in LOCAL_PHONE.finditer(text)]
    # The base spans, united to disjoint ones, are met by bisection; of the new ones only the last can overlap.
    lows, highs = [], []
    for start, end, _ in base:
        if highs and start < highs[-1]:
            highs[-1] = max(highs[-1], end)
        else:
            lows.append(start)
            highs.append(end)
    out: list[tuple[int, int, str]] = []
    for start, end, kind in sorted(found, key=lambda s: (s[0], -s[1], KINDS.index(s[2]))):
        at = bisect_right(highs, start)
        if (at < len(lows) and lows[at] < end) or (out and start < out[-1][1]):
            continue
        out.append((start, end, kind))
    return out


def issued(digits: str) -> bool:
    """Whether an issuer gives out card numbers with these first digits and of this length."""
    return any(len(digits) in sizes and low <= int(digits[: len(str(low))]) <= high for low, high, sizes in ISSUERS)


def called(digits: str) -> bool:
    """Whether a number in international form starts with a calling code."""
    return digits[:1] in CALLING_CODES or digits[:2] in CALLING_CODES or digits[:2] in CALLING_STARTS


def addressed(host: str) -> int:
    """What the registry of address ranges says of an address: of a host, of no single host, or nothing as it is none."""
    try:
        address = ipaddress.ip_address(host)
    except ValueError:
        return SILENT
    return NO if address.is_unspecified or address.is_loopback or address.is_multicast or address.is_reserved else YES


def votes(text: str, start: int, end: int, kind: str, strict: bool) -> str:
    """One digit per labeler: 1 personal, 0 not, 2 silent."""
    span = text[start:end]
    digits = digits_of(span)
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    named = [w.lower() for w in WORD.findall(before)[-1:]]
    words = {w.lower() for w in WORD.findall(before)[-4:]} | {w.lower() for w in WORD.findall(after)[:2]}
    if kind == "email":
        top = span.rsplit(".", 1)[-1] if "." in span else re.split(r"[\])}\s]+", span.strip(" )]}"))[-1]
        top = top.strip(" )]}").lower()
        checksum, known = SILENT, YES if top in TOP_DOMAINS or (len(top) == 2 and top.isalpha()) else NO
    elif kind == "ip":
        parts = re.findall("[0-9]+", span) if ":" not in span else []
        known = addressed(".".join(part.lstrip("0") or "0" for part in parts) if parts else span)
        checksum = NO if known == SILENT else YES
    elif kind == "card":
        checksum = YES if luhn(digits) else NO
        known = YES if issued(digits) else NO
    else:
        checksum = YES if 10 <= len(digits) <= 15 else NO
        abroad = digits[2:] if digits[:2] == "00" else digits if span[:1] == "+" else ""
        known = SILENT if not abroad else YES if called(abroad) else NO
    near = YES if words & NEAR[kind] else NO if words & AGAINST else SILENT
    name = YES if NEAR[kind].intersection(named) else NO if AGAINST.intersection(named) else SILENT
    border = YES if not (before[-1:].isalnum() or after[:1].isalnum()) else NO
    return "".join(map(str, (YES if strict else SILENT, checksum, known, near, name, border)))


def features(kind: str, vote: str, span: str, context: str) -> list[int]:
    """Hashed features: kind, votes, shape of the span, words around it."""
    shape = "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in span)
    names = [f"kind={kind}", *(f"{kind}:{n}={v}" for n, v in zip(LABELERS, vote, strict=True))]
    names += [f"{kind}~{shape[i : i + 3]}" for i in range(max(1, len(shape) - 2))]
    names += [f"{kind}|{w.lower()}" for w in WORD.findall(context)]
    return sorted({zlib.crc32(n.encode("utf-8", "surrogatepass")) >> (32 - HASH_BITS) for n in names})


def estimate(counts: dict[tuple[str, str], int], rounds: int = 50) -> dict[tuple[str, str], float]:
    """EM over vote patterns: the posterior of being personal for each (kind, votes).

    Per kind, each labeler has a chance of saying yes, no or nothing for
    personal and for other candidates (smoothed); labelers are independent
    given the truth. Starts from the share of yes among the votes cast.
    """
    out: dict[tuple[str, str], float] = {}
    for kind in KINDS:
        patterns = sorted(v for k, v in counts if k == kind)
        if not patterns:
            continue
        n = np.array([counts[kind, v] for v in patterns], float)
        table = np.array([[int(c) for c in v] for v in patterns])
        cast = (table != SILENT).sum(axis=1)
        truth = (1 + 2 * (table == YES).sum(axis=1)) / (2 + 2 * cast)
        for _ in range(rounds):
            weight = np.stack([(1 - truth) * n, truth * n])
            prior = (weight.sum(axis=1) + [1, 3]) / (n.sum() + 4)
            logs = np.tile(np.log(prior)[:, None], (1, len(patterns)))
            for j in range(table.shape[1]):
                says = np.stack([(weight * (table[:, j] == v)).sum(axis=1) for v in (NO, YES, SILENT)], axis=1)
                says += [[2, 1, 1], [1, 2, 1]]  # a labeler is right more often than not
                chance = says / says.sum(axis=1, keepdims=True)
                logs += np.log(chance[:, table[:, j]])
            truth = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))
        out |= {(kind, v): float(t) for v, t in zip(patterns, truth, strict=True)}
    return out


@dataclass
class SpanModel:
    """Logistic weights of hashed features."""

    weights: np.ndarray
    bias: float

    def chance(self, ids: list[int]) -> float:
        return 1 / (1 + float(np.exp(-np.clip(self.weights[ids].sum() + self.bias, -60, 60))))


def train_spans(rows: list[tuple[list[int], float]], epochs: int = 5, rate: float = 0.1, seed: int = 3) -> SpanModel:
    """Logistic regression on soft labels, by stochastic gradient descent."""
    model, rng = SpanModel(np.zeros(1 << HASH_BITS), 0.0), np.random.default_rng(seed)
    for epoch in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, target = rows[i]
            step = rate / (1 + epoch) * (target - model.chance(ids))
            model.weights[ids] += step
            model.bias += step
    return model


CANDIDATES = "array<struct<kind:string,start:int,end:int,base:boolean,votes:string,span:string,context:string>>"


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The candidates of every row, stored: id, found."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for text in frame["text"]:
                text = text if isinstance(text, str) else ""
                base = base_spans(text)
                spans = [(*s, True) for s in base] + [(*s, False) for s in wider_spans(text, base)]
                found.append(
                    [
                        {
                            "kind": kind,
                            "start": start,
                            "end": end,
                            "base": strict,
                            "votes": votes(text, start, end, kind, strict),
                            "span": text[start:end],
                            "context": text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT],
                        }
                        for start, end, kind, strict in spans
                    ]
                )
            yield pd.DataFrame({"id": frame["id"], "found": found})

    text_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return store(plain.mapInPandas(run, f"id string, found {CANDIDATES}"), "pii-candidates")


def fit(found: DataFrame, sample_spans: int = SAMPLE_SPANS) -> SpanModel:
    """Reliabilities from all candidates, the classifier from a bounded sample of the distinct ones.

    Equal candidates (kind, votes, span, context) are counted before they are
    drawn, so copies neither fill the sample nor outweigh the others. Those whose hash
    is below a share of the hash range come to the driver: about ``sample_spans`` at most.
    """
    spans = found.select(F.explode("found").alias("s")).select("s.*")
    same = ["kind", "votes", "span", "context"]
    groups = store(spans.groupBy(*same).agg(F.count(F.lit(1)).alias("n")), "pii-groups")
    counted = groups.groupBy("kind", "votes").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups")).collect()
    posterior = estimate({(r["kind"], r["votes"]): r["n"] for r in counted})
    share = sample_spans / max(1, sum(r["groups"] for r in counted))
    below = F.lit(True) if share >= 1 else F.shiftrightunsigned(F.xxhash64(*same), 1) < int(share * (1 << 63))
    taken = groups.filter(below).select(*same).collect()
    rows = [(features(r["kind"], r["votes"], r["span"], r["context"]), posterior[r["kind"], r["votes"]]) for r in sorted(taken)]
    return train_spans(rows)


def find_pii(
    docs: DataFrame,
    least: float = 0.5,
    sample_spans: int = SAMPLE_SPANS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Spans of personal data of every row: the id, ``base`` and ``spans``.

    Both are arrays of (kind, start, end) in code points, end exclusive, by
    start, then kind in the order of ``KINDS``. ``spans`` holds the base spans
    and the further candidates to which the classifier gives at least ``least``.

    A null or empty text has no spans. Rows may repeat or have null ids: one
    row out for each row in. An empty table gives no rows.
    """
    found = candidates(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(fit(found, sample_spans))
    kind = "array<struct<kind:string,start:int,end:int>>"

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for frame in frames:
            base, spans = [], []
            for row in frame["found"]:
                kept = [c for c in row if c["base"] or model.chance(features(c["kind"], c["votes"], c["span"], c["context"])) >= least]
                kept = [{"kind": c["kind"], "start": c["start"], "end": c["end"], "base": c["base"]} for c in kept]
                kept.sort(key=lambda c: (c["start"], KINDS.index(c["kind"])))
                base.append([c for c in kept if c["base"]])
                spans.append(kept)
            cut = [[[{n: c[n] for n in ("kind", "start", "end")} for c in row] for row in side] for side in (base, spans)]
            yield pd.DataFrame({"id": frame["id"], "base": cut[0], "spans": cut[1]})

    out = found.mapInPandas(decide, f"id string, base {kind}, spans {kind}")
    return out.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    for start, end, kind in sorted(spans, reverse=True):
        text = f"{text[:start]}<{kind}>{text[end:]}"
    return text
