"""Archives written and read back, revisits against a plain rule, and broken archives."""

import base64
import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from territory.llm import warc as W

SCHEMA = "page_id long, url string, html string, row string, path string"
LONG = "<p>" + "long text é 😀 " * 200_000
PAGES = [
    (3, "http://a/", "<html>same</html>"), (1, "http://b/", "<html>same</html>"), (None, "http://c/", "<html>same</html>"),
    (4, None, None), (5, "", ""), (6, "http://x/ y\r\nEvil: 1", "other\r\n\r\nWARC/1.1\r\n"), (7, "http://l/", LONG), (2, "u", LONG),
    (8, "u", "twice"), (8, "u", "twice"), (8, "v", "twice"), (None, None, None), (9, "u", "\x00\x01"), (10, "u", "a"),
]


def frame(spark, pages):
    return spark.createDataFrame([(*p, "r", "p") for p in pages], SCHEMA).repartition(3)


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(pages, least=0):
    groups = {}
    for n, (i, _, t) in enumerate(pages):
        groups.setdefault(t or "", []).append((i is None, i or 0, n, i))
    out = []
    for text, members in groups.items():
        members.sort()
        size = len(text.encode())
        for k, (_, _, _, i) in enumerate(members):
            again = k > 0 and size >= least
            out.append((i, size, sha1(text), "revisit" if again else "response", members[0][3] if again else None))
    return sorted(out, key=repr)


def read(df):
    return sorted([(r.page_id and int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in df.collect()], key=repr)


@pytest.mark.parametrize("least", [0, 1, 6])
def test_pages_come_back(spark, tmp_path, least):
    out = W.round_trip(frame(spark, PAGES), f"file://{tmp_path}/w", least_bytes=least, archive_bytes=2000)
    assert read(out) == expected(PAGES, least)
    texts = {r.page_id: r.payload.decode() for r in out.filter("record_type = 'response' and page_id in ('2', '6', '9')").collect()}
    assert texts == {"2": LONG, "6": PAGES[5][2], "9": "\x00\x01"}
    ids = [r.record_id for r in out.collect()]
    assert len(set(ids)) == len(PAGES)
    assert out.filter("target_uri = 'http://x/%20y%0D%0AEvil:%201'").count() == 1
    listed = W.read_archives(W.archives_in(spark, f"file://{tmp_path}/w"), payloads=False)
    assert read(listed) == expected(PAGES, least) and listed.filter("payload is not null").count() == 0


def test_no_pages_and_a_hot_payload(spark, tmp_path, monkeypatch):
    assert W.round_trip(frame(spark, PAGES).filter("false"), f"file://{tmp_path}/e").count() == 0
    monkeypatch.setattr(W, "HOT_SHARE", 3)
    pages = [(i, f"u{i}", "hot" if i % 2 else f"page {i // 4}") for i in range(200)]
    assert read(W.round_trip(frame(spark, pages), f"file://{tmp_path}/h", payloads=False)) == expected(pages)


def test_archives_hold_a_dictionary_and_a_frame_per_record(spark, tmp_path):
    pages = [(i, f"http://h/{i}", f"<html><body><h1>Title {i}</h1><p>{'common words of all pages ' * 20}{i * i}</p></body></html>") for i in range(300)]
    written = W.write_archives(frame(spark, pages), f"file://{tmp_path}/w").collect()
    assert sum(r.records for r in written) == 300
    for r in written:
        data = open(r.path.removeprefix("file://"), "rb").read()
        assert len(data) == r.bytes and data[:4] == b"\x5d\x2a\x4d\x18"
        size = int.from_bytes(data[4:8], "little")
        assert size > 0
        words = zstandard.ZstdCompressionDict(zstandard.decompress(data[8 : 8 + size])) if data[8:12] == b"\x28\xb5\x2f\xfd" else None
        unpacker, rest, count = zstandard.ZstdDecompressor(dict_data=words), data[8 + size :], 0
        while rest:
            one = unpacker.decompressobj()
            record = one.decompress(rest)
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            rest, count = one.unused_data, count + 1
        assert count == r.records


def archive(*records, dictionary=b"", head=None):
    pack = W._compressor(dictionary)
    return (W.dictionary_frame(dictionary) if head is None else head) + b"".join(pack.compress(r) for r in records)


GOOD = W.response(1, "1", "http://a/", b"text", W.sha1_base32(b"text"))


def test_reader_takes_small_reads_plain_dictionaries_and_other_skippable_frames():
    words = zstandard.train_dictionary(2000, [f"WARC/1.1 header {i} of a record {i * i}".encode() * 9 for i in range(400)]).as_bytes()
    plain = W.DICTIONARY_MAGIC.to_bytes(4, "little") + len(words).to_bytes(4, "little") + words
    skipped = b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc"
    data = archive(GOOD, dictionary=words, head=plain) + skipped + zstandard.ZstdCompressor().compress(GOOD)

    class Slow(io.BytesIO):
        def read(self, size=-1):
            return super().read(5)

    found = list(W.read_frames(Slow(data)))
    assert [r for _, _, r in found] == [GOOD, GOOD]
    assert [data[o : o + 4] for o, _, _ in found] == [b"\x28\xb5\x2f\xfd"] * 2
    assert found[-1][0] + found[-1][1] == len(data)
    assert W.parse_record(GOOD)["payload"] == b"text"


BROKEN = {
    "length": GOOD.replace(b"Content-Length: 82", b"Content-Length: 83", 1),
    "no length": GOOD.replace(b"Content-Length", b"Content-Size", 1),
    "payload": GOOD.replace(b"text\r\n\r\n", b"tExt\r\n\r\n"),
    "two records": GOOD + GOOD,
    "no end": GOOD[:-2],
    "no version": GOOD.replace(b"WARC/1.1", b"WORC/1.1", 1),
    "no id": GOOD.replace(b"WARC-Record-ID", b"WARC-Other", 1),
    "no headers": b"WARC/1.1\r\n",
    "nameless header": GOOD.replace(b"WARC-Date", b"no colon\r\nWARC-Date", 1),
    "not UTF-8": GOOD.replace(b"http://a/", b"http://\xff/", 1),
    "empty": b"",
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_records_are_found(name):
    with pytest.raises(W.Broken):
        W.parse_record(BROKEN[name])


def test_broken_archives_end_the_job_or_are_reported(spark, tmp_path):
    whole = archive(GOOD, GOOD)
    cases = {
        "none": (whole, 2, 0), "cut": (whole[:-3], 1, 1), "plain": (b"WARC/1.1 not compressed", 0, 1), "headless": (archive(GOOD, head=b""), 0, 1),
        "bad": (archive(GOOD, BROKEN["payload"], GOOD), 2, 1), "tail": (whole + b"garbage!", 2, 1), "bytes": (whole + b"x", 2, 1), "void": (b"", 0, 0),
    }
    paths = []
    for name, (data, _, _) in cases.items():
        (tmp_path / f"{name}.warc.zst").write_bytes(data)
        paths.append((f"file://{tmp_path}/{name}.warc.zst",))
    archives = spark.createDataFrame([*paths, (None,)], "path string")
    told = W.read_archives(archives, strict=False).groupBy("path").agg(F.count("record_id").alias("good"), F.count("error").alias("bad"))
    got = {r.path.rsplit("/", 1)[1].split(".")[0]: (r.good, r.bad) for r in told.collect()}
    assert got == {n: (g, b) for n, (_, g, b) in cases.items() if g + b}
    with pytest.raises(Exception, match="bad.warc.zst"):
        W.read_archives(archives.filter("path like '%bad%'")).count()
