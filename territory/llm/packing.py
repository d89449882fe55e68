"""Packing documents into token sequences: concatenate and cut.

Pass one tokenises every text once and stores the ids with a running count
inside the partition. The totals of the partitions (one number each) are
summed in order to give each partition its global offset. Pass two cuts the
endless row of tokens at multiples of the sequence length; a document that
crosses a boundary leaves one record on each side. Only the last sequence has
padding.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from territory.llm.blocks import REMEMBERED, byte_sizes, chunks, store, text_batches

SEQUENCE_TOKENS = 1024
#: Id that ends every document.
END_ID = 0
#: Words whose ids a worker remembers (about); those not seen for half as many new words are forgotten.
REMEMBERED_WORDS = 800_000
CHUNK_BYTES = 8 << 20

PIECES = "_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordIds(dict):
    """Token ids of a text, with the ids of repeated words remembered.

    Byte-level BPE never merges across its pre-tokens, and a single space
    between two characters that are not white space always begins one. So a
    text may be cut before such spaces and the parts encoded on their own.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.older = tokenizer, {}
        self.kind = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        (self.line_end,) = tokenizer.encode("\n", add_special_tokens=False).ids

    @staticmethod
    def parts(text: str) -> list[str]:
        words = text.split(" ")
        out = words[:1]
        for word in words[1:]:
            if not word or word[0].isspace() or not out[-1] or out[-1][-1].isspace():
                out[-1] += " " + word
            else:
                out.append(" " + word)
        return out

    @classmethod
    def marked(cls, text: str) -> str:
        """The text with a zero sign between its parts.

        Where white space comes in single signs, blanks begin a part and lone line ends are one; else ``parts`` tells them.
        """
        if not _single_spaces(text):
            return "\x00".join(cls.parts(text))
        if "\n" in text:
            text = LONE_LINE_END.sub("\x00\n\x00", text)
        return text.replace(" ", "\x00 ")

    def unknown(self, parts: Iterable[str]) -> list[str]:
        """Parts whose ids are not remembered; those of the older half are taken over."""
        out = []
        for part in parts:
            if part not in self:
                known = self.older.get(part)
                if known is None:
                    out.append(part)
                else:
                    self[part] = known
        return out

    def learn(self, parts: list[str]) -> None:
        """Ids of distinct parts.

        Signs that end a part after a letter or digit are a pre-token of their
        own, so what stands before them is encoded once for all such parts.
        Bare parts without inner white space are encoded as the lines of one
        text: a line end is a pre-token there, so its id marks where each
        part's ids end. The other parts are encoded one by one.
        """
        ended = {part: found.groups() for part in parts if (found := ENDED.fullmatch(part))}
        bare = {piece for pieces in ended.values() for piece in pieces}
        bare.update(part for part in parts if part not in ended)
        todo = self.unknown(bare)
        plain = [part for part in todo if SOLID.fullmatch(part)]
        for start in range(0, len(plain), LINES):
            block = plain[start : start + LINES]
            text = "\n".join(block) + "\n"
            (code,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(code.ids, self.kind)
            ends = np.flatnonzero(ids == self.line_end)
            if len(ends) != len(block):
                continue  # left to the others below
            raw, begin, width = ids.tobytes(), 0, self.kind.itemsize
            for part, end in zip(block, (ends * width).tolist(), strict=True):
                self[part] = raw[begin:end]
                begin = end + width
        rest = [part for part in todo if part not in self]
        for part, code in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self[part] = np.array(code.ids, self.kind).tobytes()
        for part, (head, tail) in ended.items():
            self[part] = self[head] + self[tail]

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of every text as little-endian integers; distinct parts that are still unknown are encoded first."""
        if len(self) > REMEMBERED_WORDS // 2:
            self.older = dict(self)
            self.clear()
        rows = [n for n, text in enumerate(texts) if "\x00" not in text]
        out = dict(zip(rows, self._joined([self.marked(texts[n]) for n in rows]), strict=True))
        for n, text in enumerate(texts):
            if n not in out:  # a zero sign of its own
                parts = self.parts(text)
                self.learn(self.unknown(set(parts)))
                out[n] = b"".join(map(self.__getitem__, parts))
            yield out.pop(n)

    def _joined(self, marked: list[str]) -> Iterator[bytes]:
        """The ids of marked texts: parts are split and numbered by Arrow, looked up once each and put in place by number."""
        lists = pc.split_pattern(pa.array(marked, pa.large_string()), "\x00")
        numbered = lists.flatten().dictionary_encode()
        distinct, place = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        self.learn(self.unknown(distinct))
        codes = [self[part] for part in distinct]
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // self.kind.itemsize
        starts, pool = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(codes), self.kind)
        upto = np.append(0, np.cumsum(sizes[place]))
        raw = []
        for at in range(0, len(place), GATHERED_PARTS):
            some = place[at : at + GATHERED_PARTS]
            shift = np.repeat(starts[some] - (upto[at : at + len(some)] - upto[at]), sizes[some])
            raw.append(pool[shift + np.arange(len(shift))].tobytes())
        whole = b"".join(raw)
        ends = (upto[lists.offsets.to_numpy()] * self.kind.itemsize).tolist()
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield whole[a:b]


#: A part without white space but for one blank before it.
SOLID = re.compile(r" ?\S+")
#: A part that ends with signs after a letter or digit; no apostrophe, as it may begin a pre-token with letters.
ENDED = re.compile(r"(.*[^\W_])([.,;:!?*%$#&|]+)", re.DOTALL)
#: A line end between two signs that are no white space: a pre-token of its own.
LONE_LINE_END = re.compile(r"(?<=\S)\n(?=\S)")
#: Parts that are encoded as one text.
LINES = 256
#: Parts whose ids are put in place at a time.
GATHERED_PARTS = 1 << 14

#: White space other than blank, tab and line ends.
RARE_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
BESIDE = ("  ", "\n ", " \n", "\t ", " \t", "\r ", " \r")


def _single_spaces(text: str) -> bool:
    """Whether no blank stands beside other white space or at an end."""
    return not (
        text[:1] == " " or text[-1:] == " " or any(pair in text for pair in BESIDE) or RARE_SPACE.search(text)
    )


def word_ids(path: str) -> WordIds:
    """The worker's encoder for a tokenizer file; tasks that follow in the same worker find its words."""
    if path not in REMEMBERED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        REMEMBERED[path] = WordIds(Tokenizer.from_file(path))
    return REMEMBERED[path]


def token_rows(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's token ids, stored: pass one.

    Columns: ``_part`` (partition), ``_before`` (tokens before it there),
    ``_id``, ``n`` and ``ids`` (little-endian unsigned integers of 16 bits if
    the vocabulary fits, else 32). ``tokenizer_path`` names a file that every worker has.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, part, before = word_ids(tokenizer_path), TaskContext.get().partitionId(), 0
        for frame in chunks(frames, byte_sizes("text"), CHUNK_BYTES):
            texts = frame["text"].where(frame["text"].notna(), "").tolist()
            end = np.array([END_ID], words.kind).tobytes()
            blobs = [ids + end for ids in words.batch(texts)]
            n = np.array([len(blob) // words.kind.itemsize for blob in blobs], np.int64)
            yield pd.DataFrame(
                {"_part": part, "_before": before + np.cumsum(n) - n, "_id": frame["id"], "n": n, "ids": blobs}
            )
            before += int(n.sum())

    text_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    out = plain.mapInPandas(run, "_part long, _before long, _id string, n long, ids binary")
    return store(out, "token-rows")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = SEQUENCE_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of sequences of ``length`` tokens that hold every document.

    One row per piece: the id, ``start`` (ids of its document before it),
    ``length``, ``ids_crc32`` (of the ids as little-endian 32-bit integers),
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence and, if asked
    for, ``ids``. Pieces fill their sequence without gaps from offset 0; every
    sequence but the last is full, so at most ``length - 1`` ids of padding
    are needed for the whole table. Documents follow each other in storage order.

    A null text counts as empty and leaves one piece with its end id. A null
    or repeated id is carried along; each row is a document. An empty table
    gives no pieces. Other columns are ignored.
    """
    rows = token_rows(docs, tokenizer_path, id_col, text_col)
    totals = {r["_part"]: r["n"] for r in rows.groupBy("_part").agg(F.sum("n").alias("n")).collect()}
    offsets, total = {}, 0
    for part in sorted(totals):
        offsets[part], total = total, total + totals[part]
    shared = docs.sparkSession.sparkContext.broadcast(offsets)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        for frame in frames:
            out = []
            for part, before, key, n, blob in frame.itertuples(index=False, name=None):
                ids = np.frombuffer(blob, "<u2" if len(blob) == 2 * n else "<u4").astype("<u4")
                at, start = shared.value[part] + before, 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    take = min(n - start, length - offset)
                    piece = ids[start : start + take].tobytes()
                    out.append((key, start, take, zlib.crc32(piece), n, sequence, offset, piece if with_ids else None))
                    start += take
            made = pd.DataFrame(out, columns=names)
            yield made if with_ids else made.drop(columns="ids")

    pieces = rows.mapInPandas(cut, PIECES + (", ids binary" if with_ids else ""))
    return pieces.withColumn("_id", F.col("_id").cast(docs.schema[id_col].dataType)).withColumnRenamed("_id", id_col)


def sequences(pieces: DataFrame, length: int = SEQUENCE_TOKENS, pad_id: int = END_ID) -> DataFrame:
    """Whole sequences out of pieces that carry their ``ids``: sequence_id, ids, n_tokens.

    A sequence is padded to ``length`` with ``pad_id``, except when its number
    of tokens is a power of two: such a sequence stays as it is.
    """

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values("offset")
        ids = np.frombuffer(b"".join(ordered["ids"]), "<u4")
        n = len(ids)
        if n & (n - 1):
            ids = np.append(ids, np.full(length - n, pad_id, np.uint32))
        return pd.DataFrame({"sequence_id": [frame["sequence_id"].iloc[0]], "ids": [ids.astype(np.int64)], "n_tokens": [n]})

    return pieces.groupBy("sequence_id").applyInPandas(fill, "sequence_id long, ids array<long>, n_tokens long")


