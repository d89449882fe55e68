"""Web archives (WARC 1.1) with a Zstandard frame per record and a shared dictionary.

An archive starts with a skippable frame that holds the dictionary, itself
compressed; every record after it is one frame of its own. The reader loads the
dictionary, decodes frame after frame and validates headers, lengths and
digests; it holds one record at a time.

Pages are compressed once, into frames that travel through Spark in place of the
texts; duplicates are found on digests and lengths; a task appends frames
to archives in a shared folder and returns their names, so an attempt that failed
leaves files that nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from territory.llm.blocks import store, text_batches
from territory.operators.storage import checkpoint_folder

#: Magic numbers of the dictionary's frame, of any skippable frame (16 of them) and of a data frame.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
FRAME_MAGIC = 0xFD2FB528

VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records carry this date unless the caller gives another: archives of equal pages are equal.
DATE = "1970-01-01T00:00:00Z"

#: The dictionary is trained on at most so many pages and so many bytes of each, and has at most so many bytes.
DICTIONARY_PAGES = 1000
DICTIONARY_PAGE_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Bytes that the reader takes at a time.
READ_BYTES = 1 << 20
#: A payload that at least one row in so many has is hot.
HOT_SHARE = 1000

FRAMES = "row long, id string, payload_sha256 string, payload_bytes long, payload_digest string, uri string, frame binary"
ARCHIVES = "path string, records long, bytes long"
RECORDS = (
    "path string, offset long, bytes long, record_id string, record_type string, page_id string, refers_to string, "
    "target_uri string, payload_bytes long, payload_digest string, payload binary, error string"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(row: int) -> str:
    """A URN for a row of the table; the same one in every attempt."""
    return f"<{uuid.UUID(bytes=hashlib.blake2b(str(row).encode(), digest_size=16).digest()).urn}>"


def clean_uri(uri: str) -> str:
    """A URI without characters that would end a header: they are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


def record_bytes(headers: dict[str, str | None], block: bytes) -> bytes:
    """One record: version, headers (those without a value are left out), block, two empty lines."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers.items() if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def _headers(kind: str, row: int, page: str | None, uri: str | None, block: bytes, digest: str, date: str) -> dict[str, str | None]:
    return {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(row),
        "WARC-Date": date,
        "WARC-Target-URI": clean_uri(uri) if uri else None,
        "WARC-Page-ID": page,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
        "WARC-Payload-Digest": f"sha1:{digest}",
    }


def response(row: int, page: str | None, uri: str | None, payload: bytes, digest: str, date: str = DATE) -> bytes:
    block = http_head(len(payload)) + payload
    return record_bytes(_headers("response", row, page, uri, block, digest, date), block)


def revisit(row: int, page: str | None, uri: str | None, length: int, digest: str, of: tuple[int, str | None, str | None], date: str = DATE) -> bytes:
    """A record that stands for a payload that the record ``of`` (row, id, address) holds."""
    block = http_head(length)
    of_row, of_page, of_uri = of
    headers = _headers("revisit", row, page, uri, block, digest, date) | {
        "WARC-Profile": REVISIT_PROFILE,
        "WARC-Refers-To": record_id(of_row),
        "WARC-Refers-To-Page-ID": of_page,
        "WARC-Refers-To-Target-URI": clean_uri(of_uri) if of_uri else None,
        "WARC-Refers-To-Date": date,
    }
    return record_bytes(headers, block)


def train_dictionary(pages: DataFrame, html_col: str) -> bytes:
    """A dictionary from a sample of the pages; empty if there is too little to learn from.

    The sample is bounded by ``DICTIONARY_PAGES`` and ``DICTIONARY_PAGE_BYTES``; rows are drawn by a share, so
    tasks send no more than that together. The dictionary decides how small archives are, never what they hold.
    """
    start = F.substring(F.encode(F.col(html_col), "UTF-8"), 1, DICTIONARY_PAGE_BYTES)
    share = min(1.0, 0.8 * DICTIONARY_PAGES / max(1, pages.count()))
    drawn = pages.sample(share, seed=7).filter(F.length(html_col) > 0).select(start.alias("b"))
    samples = [bytes(r["b"]) for r in drawn.limit(DICTIONARY_PAGES).collect()]
    total = sum(map(len, samples))
    if len(samples) < 8 or total < 8 << 10:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 4), samples).as_bytes()
    except zstandard.ZstdError:  # samples too much alike to learn from
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading skippable frame of an archive."""
    packed = zstandard.compress(dictionary) if dictionary else b""
    return DICTIONARY_MAGIC.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _frames(pages: DataFrame, dictionary: bytes, id_col: str, uri_col: str, html_col: str, date: str) -> DataFrame:
    """Every page as a compressed response record, with what is needed to compare payloads."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = _compressor(dictionary)
        for frame in frames:
            out = []
            for row, page, uri, html in frame.itertuples(index=False, name=None):
                payload = (html or "").encode("utf-8", "surrogatepass")
                digest = sha1_base32(payload)
                record = packer.compress(response(row, page, uri, payload, digest, date))
                out.append((row, page, hashlib.sha256(payload).hexdigest(), len(payload), digest, uri, record))
            yield pd.DataFrame(out, columns=["row", "id", "payload_sha256", "payload_bytes", "payload_digest", "uri", "frame"])

    text_batches(pages.sparkSession)
    cells = pages.select(
        F.monotonically_increasing_id(), F.col(id_col).cast("string"), F.col(uri_col).cast("string"), F.col(html_col).cast("string")
    )
    return store(cells.mapInPandas(run, FRAMES), "warc-frames")


def _revisits(frames: DataFrame, id_type, least_bytes: int) -> DataFrame:
    """Rows whose payload another row holds: ``row`` and that row's ``of_row``, ``of_id``, ``of_uri``.

    Ids are compared in their own type. A group with a ``HOT_SHARE``-th of all rows
    or more meets its rows by broadcast: there are at most ``HOT_SHARE`` such groups.
    """
    rows = frames.filter(F.col("payload_bytes") >= least_bytes).select("row", "id", "uri", "payload_sha256")
    place = F.struct(F.col("id").isNull(), F.col("id").cast(id_type), "row")
    head = F.struct(F.col("row").alias("of_row"), F.col("id").alias("of_id"), F.col("uri").alias("of_uri"))
    heads = rows.groupBy("payload_sha256").agg(F.count(F.lit(1)).alias("n"), F.min_by(head, place).alias("head"))
    shared = store(heads.filter("n > 1").select("payload_sha256", "n", "head.*"), "warc-shared")
    hot = F.col("n") * HOT_SHARE >= frames.count()
    key = rows.select("row", "payload_sha256")
    many = F.broadcast(shared.filter(hot).drop("n"))
    few = shared.filter(~hot).drop("n")
    others = key.join(many, "payload_sha256", "left_anti").join(few, "payload_sha256")
    found = key.join(many, "payload_sha256").unionByName(others)
    return found.filter("row != of_row").drop("payload_sha256")


def _write_archives(rows: DataFrame, folder: str, dictionary: bytes, date: str, archive_bytes: int) -> DataFrame:
    """Archives of the frames of each partition; a row per archive that a finished task closed."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = pyarrow.fs.FileSystem.from_uri(folder)
        packer = _compressor(dictionary)
        out, done, path, count, size = None, [], "", 0, 0
        for frame in frames:
            for r in frame.itertuples(index=False):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    path, count, size = f"{folder}/{name}", 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    size += out.write(dictionary_frame(dictionary))
                record = r.frame
                if not pd.isna(r.of_row):
                    of = int(r.of_row), r.of_id, r.of_uri
                    record = packer.compress(revisit(r.row, r.id, r.uri, r.payload_bytes, r.payload_digest, of, date))
                size += out.write(record)
                count += 1
                if size >= archive_bytes:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    return store(rows.mapInPandas(run, ARCHIVES), "warc-archives")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    uri_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    date: str = DATE,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record for every row of ``pages`` below ``folder``; a row per archive: path, records, bytes.

    ``folder`` is a URI of a folder that all executors share (``file:``, ``hdfs:``, ``s3:``, ``gs:``, ...).
    Only archives in the returned rows belong to the result. Of rows with equal payloads
    of at least ``least_bytes`` bytes, the one with the smallest id is a response
    and the others are revisits of it; smaller payloads are responses each.
    Payloads are equal if their SHA-256 is.

    A null text is an empty payload, and equal to other empty ones. A null id comes after all others and
    is left out of the headers, as is a null or empty address; rows that share
    id and payload, whole repeated rows too, are a record each, the first in storage order before the others.
    Control characters and blanks of an address are percent-encoded. An empty table gives no archive.
    Other columns are ignored.
    """
    system, base = pyarrow.fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    dictionary = train_dictionary(pages, html_col)
    frames = _frames(pages, dictionary, id_col, uri_col, html_col, date)
    decided = _revisits(frames, pages.schema[id_col].dataType, least_bytes)
    return _write_archives(frames.join(decided, "row", "left"), folder, dictionary, date, archive_bytes)


class Broken(ValueError):
    """An archive that does not keep to the format."""


def _load_dictionary(body: bytes) -> bytes:
    """A dictionary as the frame holds it: compressed or plain."""
    if body[:4] == FRAME_MAGIC.to_bytes(4, "little"):
        return zstandard.ZstdDecompressor().decompressobj().decompress(body)
    return body


def read_frames(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, compressed bytes, record) of every data frame of an archive.

    ``stream`` gives bytes by ``read``. Other skippable frames are passed over.
    """
    held, offset, ended = b"", 0, False

    def more() -> bool:
        nonlocal held, ended
        data = b"" if ended else stream.read(READ_BYTES)
        ended = not data
        held += data
        return not ended

    def need(size: int) -> bool:
        while len(held) < size and more():
            pass
        return len(held) >= size

    unpacker = None
    while need(1):
        if not need(8):
            raise Broken(f"offset {offset}: the archive ends inside a frame")
        magic = int.from_bytes(held[:4], "little")
        if magic & ~0xF == SKIPPABLE_MAGIC:
            size = 8 + int.from_bytes(held[4:8], "little")
            if not need(size):
                raise Broken(f"offset {offset}: the archive ends inside a frame")
            if unpacker is None:
                if magic != DICTIONARY_MAGIC:
                    raise Broken("the first frame holds no dictionary")
                loaded = _load_dictionary(held[8:size])
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(loaded) if loaded else None)
            held, offset = held[size:], offset + size
            continue
        if unpacker is None:
            raise Broken("the first frame holds no dictionary")
        if magic != FRAME_MAGIC:
            raise Broken(f"offset {offset}: no frame starts here")
        frame, parts, taken = unpacker.decompressobj(), [], 0
        while True:
            try:
                parts.append(frame.decompress(held))
            except zstandard.ZstdError as error:
                raise Broken(f"offset {offset}: {error}") from error
            taken += len(held) - len(frame.unused_data)
            held = frame.unused_data
            if frame.eof:
                break
            if not more():
                raise Broken(f"offset {offset}: the archive ends inside a frame")
        yield offset, taken, b"".join(parts)
        offset += taken


def _split_head(data: bytes, what: str) -> tuple[str, dict[str, str], bytes]:
    """First line, headers (names in lower case) and the rest."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise Broken(f"the headers of the {what} do not end")
    first, *lines = data[:end].decode("utf-8", "strict").split("\r\n")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise Broken(f"a header of the {what} has no name")
        headers[name.lower()] = value.strip()
    return first, headers, data[end + 4 :]


def _length(headers: dict[str, str], what: str) -> int:
    value = headers.get("content-length", "")
    if not re.fullmatch("[0-9]+", value):
        raise Broken(f"the {what} has no length")
    return int(value)


def parse_record(data: bytes) -> dict:
    """The parts of a record that a frame holds, validated; ``Broken`` if it is no whole single record."""
    try:
        first, headers, rest = _split_head(data, "record")
        if not re.fullmatch(r"WARC/1\.[0-9]+", first):
            raise Broken("the record does not start with its version")
        for name in ("warc-type", "warc-record-id", "warc-date"):
            if not headers.get(name):
                raise Broken(f"the record lacks {name}")
        size = _length(headers, "record")
        if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
            raise Broken("the length of the record is wrong")
        block, kind = rest[:size], headers["warc-type"]
        if headers.get("warc-block-digest", f"sha1:{sha1_base32(block)}") != f"sha1:{sha1_base32(block)}":
            raise Broken("the digest of the block is wrong")
        out = {"record_id": headers["warc-record-id"], "record_type": kind, "page_id": headers.get("warc-page-id")}
        out |= {"refers_to": headers.get("warc-refers-to-page-id"), "target_uri": headers.get("warc-target-uri")}
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "response":
            _, http, payload = _split_head(block, "response")
            if _length(http, "response") != len(payload):
                raise Broken("the length of the payload is wrong")
            if digest != sha1_base32(payload):
                raise Broken("the digest of the payload is wrong")
            return out | {"payload_bytes": len(payload), "payload_digest": digest, "payload": payload}
        if kind == "revisit":
            for name in ("warc-refers-to", "warc-profile"):
                if not headers.get(name):
                    raise Broken(f"the revisit lacks {name}")
            _, http, payload = _split_head(block, "revisit")
            if payload or not digest:
                raise Broken("the revisit holds a payload or no digest")
            return out | {"payload_bytes": _length(http, "revisit"), "payload_digest": digest, "payload": None}
        return out | {"payload_bytes": None, "payload_digest": digest or None, "payload": block}
    except UnicodeDecodeError as error:
        raise Broken("a header is not UTF-8") from error


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the archives of a folder that somebody else wrote; none of them is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", True)
    return files.load(folder).select("path", F.col("length").alias("bytes"))


def read_archives(archives: DataFrame, payloads: bool = True, strict: bool = True) -> DataFrame:
    """One row per record of the archives whose URIs are in column ``path``.

    Columns: where the record stands (``path``, ``offset``, ``bytes``), its headers, the
    length and digest of the full payload, and the ``payload`` itself unless ``payloads`` is
    off. An archive is one task's work, one record at a time.

    A record that breaks the format ends the job with its archive and offset; without ``strict`` it is a row with
    ``error``, and a frame that cannot be decoded ends its archive there. Null paths and repeated
    paths: null ones are passed over, repeated ones read again. No archives give no rows.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        blank = dict.fromkeys(names)
        for frame in frames:
            for path in frame["path"]:
                system, place = pyarrow.fs.FileSystem.from_uri(path)
                rows, held, offset = [], 0, 0
                with system.open_input_stream(place, compression=None) as stream:
                    found = read_frames(stream)
                    while True:
                        try:
                            where = next(found, None)
                            if where is None:
                                break
                            offset, size, data = where
                            row = blank | {"path": path, "offset": offset, "bytes": size}
                            try:
                                row |= parse_record(data)
                            except Broken as error:
                                if strict:
                                    raise
                                row |= {"error": str(error)}
                        except Broken as error:
                            if strict:
                                raise Broken(f"{path}, offset {offset}: {error}") from error
                            row = blank | {"path": path, "offset": offset, "error": str(error)}
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += 200 + len(row["payload"] or b"")
                        if held > 8 << 20:
                            yield _table(rows, names)
                            rows, held = [], 0
                yield _table(rows, names)

    spark = archives.sparkSession
    paths = archives.filter(F.col("path").isNotNull()).select("path")
    tasks = max(1, min(paths.count(), 100_000))
    return paths.repartition(tasks).mapInPandas(run, RECORDS)


def _table(rows: list[dict], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    for name in ("offset", "bytes", "payload_bytes"):
        frame[name] = pd.array(frame[name], dtype=pd.Int64Dtype())
    return frame


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives, in the shared checkpoint folder."""
    folder = f"{checkpoint_folder(spark)}/llm/warc-{uuid.uuid4().hex}"
    return folder if re.match("[A-Za-z][A-Za-z0-9+.-]*:", folder) else f"file://{folder}"


def round_trip(pages: DataFrame, folder: str | None = None, payloads: bool = True, **options) -> DataFrame:
    """``pages`` written to archives and read back: the rows of ``read_archives``."""
    written = write_archives(pages, folder or archive_folder(pages.sparkSession), **options)
    return read_archives(written, payloads)
