"""Archives: round trip, revisits by brute force, a plain reader of the format, and broken files."""

import hashlib
import struct
from pathlib import Path

import pytest
import zstandard

from framewright.llm import warc

SCHEMA = "page_id long, url string, html string, key binary, size int, record_id string"


def pages():
    big, hot = "".join(f"<p>part {i} of it</p>\n" for i in range(200)), "é" * 600
    texts = [None, "", "a", "b" * 999, "b" * 1000, big, big, hot, "\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" * 60, "x" * 3_000_000, "b" * 999]
    rows = [(i, f"http://h.example/{i}", t, b"k", 1, "r") for i, t in enumerate(texts)]
    rows += [(100 + i, "http://hot.example/\r\nWARC-Type: metadata", hot, None, None, None) for i in range(40)]
    return [*rows, (None, None, big, None, None, None), (None, None, "alone " * 300, None, None, None), rows[5], (160, None, "t" * 2000, None, None, None), (160, None, "t" * 2000, None, None, None), (5, None, "t" * 2000, None, None, None)]


def expected(rows):
    texts = [(i, (t or "").encode()) for i, _, t, *_ in rows]
    keeper = {}
    for i, t in texts:
        if len(t) >= 1000 and i is not None:
            keeper[t] = max(i, keeper.get(t, i))
    out = []
    for i, t in texts:
        k = keeper.get(t)
        first = k is None or i == k
        out.append((i, len(t), hashlib.sha1(t).hexdigest(), "response" if first else "revisit", None if first else k))
    return sorted(out, key=repr)


def test_report(spark):
    rows = pages()
    got = warc.report(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_empty(spark):
    assert warc.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_small_archives_read_by_hand(spark):
    """Frames as the library sees them: a dictionary first, then a record a frame."""
    rows = [(i, "http://h/", "".join(f"line {j * i} of text " for j in range(120)), None, None, None) for i in range(60)]
    path = warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2), archive_bytes=4000)
    files = [p for p in Path(path.removeprefix("file:")).iterdir() if p.name.startswith("part-")]
    assert len(files) > 4
    ids = []
    for f in files:
        data = f.read_bytes()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICT_FRAME
        z = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
        rest = data[8 + size :]
        while not rest.startswith(struct.pack("<I", warc.FILL_FRAME)):
            one = z.decompressobj()
            record = one.decompress(rest)
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            ids += [line for line in record.decode().split("\r\n") if line.startswith("Page-ID")]
            rest = one.unused_data
        assert rest == struct.pack("<II", warc.FILL_FRAME, 1) + b"\n"
    assert sorted(ids) == sorted(f"Page-ID: {i}" for i in range(60))
    assert warc.read_archives(spark, path).count() == 60


def record(**changed):
    block = b"HTTP/1.1 200 OK\r\n\r\nabc"
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<urn:x:1>", "WARC-Date": "2020-01-01T00:00:00Z", "Content-Type": "application/http", "WARC-Payload-Digest": warc._digest(b"abc")}
    return warc.build_record({k: v for k, v in (fields | changed).items() if v is not None}, block)


def test_record_checks():
    assert warc.describe(record())[4:6] == (3, hashlib.sha1(b"abc").hexdigest())
    assert warc.describe(record(**{"WARC-Payload-Digest": "sha1:" + hashlib.sha1(b"abc").hexdigest()}))[4] == 3
    bad = [
        record().replace(b"WARC/1.1", b"WARC/9.9"), record(**{"WARC-Date": None}), record(**{"WARC-Type": None}), record(**{"WARC-Payload-Digest": warc._digest(b"abd")}),
        record(**{"WARC-Block-Digest": warc._digest(b"")}), record()[:-1], record() + b"x", record().replace(b"Content-Length: 22", b"Content-Length: 21"), record().replace(b"WARC-Date:", b"no colon"),
        record(**{"WARC-Type": "revisit"}), record() + record(), record().replace(b"WARC-Date", b"WARC-Type"), b"", b"WARC/1.1\r\n",
    ]
    for r in bad:
        with pytest.raises(ValueError):
            warc.describe(r)


def test_broken_files(spark, tmp_path):
    z = zstandard.ZstdCompressor()
    good = z.compress(record())
    raw = warc.train([b"".join(b"word %d %d " % (i, j * i % 17) for j in range(60)) for i in range(300)])
    own = warc.compressor(raw).compress(record())
    files = {
        "plain": good + warc.skippable(0x184D2A53, b"skipped") + good, "cut": good + good[:-5], "garbage": good + b"not a frame", "two": z.compress(record() + record()),
        "packed": warc.skippable(warc.DICT_FRAME, z.compress(raw)) + own, "no-dictionary": own, "cut-dictionary": warc.skippable(warc.DICT_FRAME, raw)[:50], "nothing": b"",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    count = {}
    for name in files:
        rows = warc.read_archives(spark, str(tmp_path / name), strict=False).collect()
        count[name] = (sum(r.problem is None for r in rows), sum(r.problem is not None for r in rows))
    assert count == {"plain": (2, 0), "cut": (1, 1), "garbage": (1, 1), "two": (0, 1), "packed": (1, 0), "no-dictionary": (0, 1), "cut-dictionary": (0, 1), "nothing": (0, 0)}
    with pytest.raises(Exception, match="cut off"):
        warc.read_archives(spark, str(tmp_path / "cut")).collect()


def test_revisit_without_response(spark):
    row = [("<urn:x:2>", "revisit", 2, "u", None, "0" * 40, "<urn:x:1>", None)]
    lone = spark.createDataFrame(row, warc._RECORD)
    assert warc.resolve(lone, strict=False).collect() == [(2, None, "0" * 40, "revisit", None)]
    with pytest.raises(Exception, match="no response with this payload"):
        warc.resolve(lone).collect()
