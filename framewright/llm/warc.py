"""Operator 13: Zstandard WARC archives, one frame a record, written and read back.

An archive opens with a skippable frame that holds the compression dictionary, then a `warcinfo` record
and one frame a record. Payloads of ``least`` bytes or more are stored once: the record with the largest
id is the `response`, equal ones are `revisit` records that refer to it (identical-payload-digest profile).
Equality is decided by SHA-256. Records are compressed where the pages are read, so only frames and keys
are shuffled, the copies of a hot payload being dealt over all tasks. Spark's text writer stores each
archive as a file of its own: an archive ends in the header of a one-byte skippable frame, whose content
is the line end that the writer adds.

The reader takes any folder of such archives. It loads the dictionary (plain or itself compressed), skips
other skippable frames, decodes a frame at a time, and checks version, headers, the record's length against
Content-Length, its end, and both digests. A revisit's size comes from the response it refers to. What is
wrong is an error with ``strict``, else a row with ``problem``.

A null payload is empty; a null url stands as the record's own id. Of equal payloads a null id counts as the
smallest, and rows that repeat the largest id are responses all. An empty table gives no archives and no rows.
The dictionary is trained on a random sample of some ``SAMPLE`` payloads of up to ``SAMPLE_BYTES`` bytes each; where that is
too little to train on, archives have none.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import in_scope, materialize, parts, spread_join
from framewright.sources.scratch import scratch_path

SAMPLE, SAMPLE_BYTES, DICT_BYTES = 400, 16 << 10, 32 << 10
ARCHIVE_BYTES = 48 << 20
LEVEL = 3
# Fixed values of the formats.
DICT_FRAME, FILL_FRAME, ZSTD_FRAME = 0x184D2A5D, 0x184D2A50, b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Record-ID", "Content-Length", "WARC-Date", "WARC-Type")
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_RECORD = "record_id string, record_type string, page_id long, uri string, payload_bytes long, payload_digest string, refers string, problem string"
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]


def record_id(page_id: int | None, key: bytes) -> str:
    """The same for equal ids and payloads."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{key.hex()}')}>"


def _header_value(text: str) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in text)


def build_record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in (fields | {"Content-Length": str(len(block))}).items())
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _fields(kind: str, page_id: int | None, key: bytes, uri: str | None, date: str, digest: str) -> dict[str, str]:
    own = record_id(page_id, key)
    fields = {"WARC-Type": kind, "WARC-Record-ID": own, "WARC-Date": date, "WARC-Target-URI": own[1:-1] if uri is None else _header_value(uri), "WARC-Payload-Digest": digest}
    return fields | {"Content-Type": "application/http;msgtype=response"} | ({} if page_id is None else {"Page-ID": str(page_id)})


def response(page_id: int | None, key: bytes, uri: str | None, payload: bytes, date: str, digest: str) -> bytes:
    block = _HTTP.format(len(payload)).encode() + payload
    return build_record(_fields("response", page_id, key, uri, date, digest) | {"WARC-Block-Digest": _digest(block)}, block)


def revisit(page_id: int | None, key: bytes, uri: str | None, size: int, keeper: int, date: str, digest: str) -> bytes:
    block = _HTTP.format(size).encode()
    refer = {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(keeper, key), "WARC-Refers-To-Date": date, "WARC-Block-Digest": _digest(block)}
    return build_record(_fields("revisit", page_id, key, uri, date, digest) | refer, block)


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def train(samples: list[bytes]) -> bytes:
    """A dictionary, or nothing where the samples are too few."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes() if len(samples) > 7 else b""
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", least: int = 1000, archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> str:
    """Write every row as a record; the folder of the archives."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(uri_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    n_rows = pages.count()
    sample = rows.sample(min(1.0, SAMPLE / max(n_rows, 1)), seed=13).where(F.octet_length("payload") > 0).select(F.substring("payload", 1, SAMPLE_BYTES).alias("s"))
    dictionary = train([bytes(r.s) for r in sample.collect()])

    grouped = rows.where(F.octet_length("payload") >= least).groupBy("key").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies"))
    copied = materialize(grouped.where("copies > 1"), "warc-copies")
    hot = copied.where(F.col("copies") > n_rows / parts(spark)).select(F.col("key").alias("__hot"))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = compressor(dictionary)
        for batch in batches:
            frames, sizes, digests = [], [], []
            for page_id, url, data, key in zip(*batch.columns, strict=True):
                body = data.as_py()
                digests.append(_digest(body))
                sizes.append(len(body))
                frames.append(z.compress(response(page_id.as_py(), key.as_py(), url.as_py(), body, date, digests[-1])))
            added = [pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(frames, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *added], ["page_id", "url", "key", "size", "digest", "frame"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = compressor(dictionary)
        info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date, "Content-Type": "application/warc-fields"}
        head = (skippable(DICT_FRAME, dictionary) if dictionary else b"") + z.compress(build_record(info, b"format: WARC File Format 1.1\r\n"))
        tail = struct.pack("<II", FILL_FRAME, 1)
        held: list[bytes] = []
        n = 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([head + b"".join(held) + tail], pa.binary())], ["value"])

        for batch in batches:
            for page_id, url, key, size, digest, frame, keeper in zip(*batch.columns, strict=True):
                own, first = page_id.as_py(), keeper.as_py()
                if first is None or own == first:
                    held.append(frame.as_py())
                else:
                    held.append(z.compress(revisit(own, key.as_py(), url.as_py(), size.as_py(), first, date, digest.as_py())))
                n += len(held[-1])
                if n >= archive_bytes:
                    yield archive()
                    held, n = [], 0
        if held:
            yield archive()

    frames = rows.mapInArrow(compress, "page_id long, url string, key binary, size long, digest string, frame binary")
    joined = spread_join(frames, copied.select("key", "keeper"), "key", n_rows, hot=hot).select("page_id", "url", "key", "size", "digest", "frame", "keeper")
    path = scratch_path(spark, "warc")
    # The writer takes strings and writes their bytes as they are.
    joined.mapInArrow(pack, "value binary").select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(path)
    in_scope(path)
    return path


def frames(data: memoryview) -> Iterator[tuple[bytes, str | None]]:
    """(record, problem) of each frame; nothing after a broken frame can be found, so it is the last."""
    z, at = zstandard.ZstdDecompressor(), 0
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICT_FRAME:
        size = struct.unpack_from("<I", data, 4)[0]
        raw, at = bytes(data[8 : 8 + size]), 8 + size
        try:
            if at > len(data):
                raise ValueError("the dictionary's frame is cut off")
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw) if raw[:4] == ZSTD_FRAME else raw
            z = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, zstandard.DICT_TYPE_FULLDICT))
        except (ValueError, zstandard.ZstdError) as e:
            yield b"", f"dictionary: {e}"
            return
    while at < len(data):
        if len(data) - at >= 8 and struct.unpack_from("<I", data, at)[0] & 0xFFFFFFF0 == FILL_FRAME:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            if at > len(data):
                yield b"", "a skippable frame is cut off"
            continue
        one, out, begun = z.decompressobj(), [], at
        try:
            while not one.eof and at < len(data):
                out.append(one.decompress(data[at : at + 16384]))
                at = min(at + 16384, len(data))
        except zstandard.ZstdError as e:
            yield b"", f"frame at {begun}: {e}"
            return
        if not one.eof:
            yield b"", f"frame at {begun} is cut off"
            return
        at -= len(one.unused_data)
        yield b"".join(out), None


def _same_digest(stated: str, data: bytes) -> bool:
    name, _, value = stated.partition(":")
    found = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "md5": hashlib.md5}.get(name.lower())
    if found is None:
        return True
    d = found(data).digest()
    return value in (d.hex(), d.hex().upper()) or value.rstrip("=").upper() == base64.b32encode(d).decode().rstrip("=")


def _hex_digest(stated: str) -> str:
    value = stated.partition(":")[2]
    return value.lower() if len(value) == 40 else base64.b32decode(value + "=" * (-len(value) % 8), casefold=True).hex()


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block; ValueError where version, headers, length or end are not those of one record."""
    cut = record.find(b"\r\n\r\n")
    if cut < 0:
        raise ValueError("the headers do not end")
    lines = record[:cut].decode("utf-8", "replace").split("\r\n")
    if lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"unknown version {lines[0][:20]!r}")
    fields: dict[str, str] = {}
    names = {x.lower(): x for x in (*MANDATORY, "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Block-Digest", "WARC-Refers-To", "Content-Type", "Page-ID")}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"not a header: {line[:40]!r}")
        name = names.get(name.lower(), name)
        if name in fields and name in names.values():
            raise ValueError(f"{name} comes twice")
        fields[name] = value.strip()
    for name in MANDATORY:
        if not fields.get(name):
            raise ValueError(f"{name} is missing")
    if not fields["Content-Length"].isdecimal():
        raise ValueError("Content-Length is not a number")
    size, rest = int(fields["Content-Length"]), len(record) - cut - 4
    if rest != size + 4 or record[-4:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {size}, the record has {rest - 4} and its end")
    return fields, record[cut + 4 : -4]


def describe(record: bytes) -> tuple:
    """One row of ``read_archives``; ValueError for what is wrong."""
    fields, block = parse_record(record)
    kind = fields["WARC-Type"]
    if "WARC-Block-Digest" in fields and not _same_digest(fields["WARC-Block-Digest"], block):
        raise ValueError("the block differs from its digest")
    payload = block
    if fields.get("Content-Type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        if cut < 0:
            raise ValueError("the HTTP headers do not end")
        payload = block[cut + 4 :]
    stated = fields.get("WARC-Payload-Digest")
    if kind == "revisit":
        if not stated or "WARC-Refers-To" not in fields:
            raise ValueError("a revisit without digest or the record it refers to")
        size, digest = None, _hex_digest(stated)
    else:
        if stated and not _same_digest(stated, payload):
            raise ValueError("the payload differs from its digest")
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    page = fields.get("Page-ID")
    return fields["WARC-Record-ID"], kind, None if page is None else int(page), fields.get("WARC-Target-URI"), size, digest, fields.get("WARC-Refers-To"), None


def read_archives(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(record_id, record_type, page_id, uri, payload_bytes, payload_digest, refers, problem) of every record but `warcinfo`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*batch.columns, strict=True):
                rows: list[tuple] = []
                for record, problem in frames(memoryview(content.as_buffer())):
                    try:
                        if problem:
                            raise ValueError(problem)
                        row = describe(record)
                    except ValueError as e:
                        if strict:
                            raise ValueError(f"{name.as_py()}: {e}") from e
                        row = (*[None] * 7, str(e))
                    if row[1] != "warcinfo":
                        rows.append(row)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS)], [c.split()[0] for c in _RECORD.split(", ")])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _RECORD)


def resolve(records: DataFrame, strict: bool = True) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits take size and id from the response they refer to."""
    spark = records.sparkSession
    stored = materialize(records, "warc-records")
    again = stored.where("record_type = 'revisit'").withColumnRenamed("refers", "rid")
    firsts = stored.where("record_type = 'response'").groupBy(F.col("record_id").alias("rid")).agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("size"), F.first("payload_digest").alias("sha")
    )
    met = spread_join(again, firsts, "rid", max(again.count(), parts(spark)))
    wrong = F.concat(F.lit("no response with this payload: "), F.col("record_id"))
    right = F.col("sha") == F.col("payload_digest")
    size = F.when(right, F.col("size"))
    met = met.withColumn("payload_bytes", F.coalesce(size, F.raise_error(wrong).cast("long")) if strict else size)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    rest = stored.where("record_type <> 'revisit'").select(*columns, F.lit(None).cast("long").alias("refers_to"))
    return rest.unionByName(met.select(*columns, "refers_to"))


def report(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, and describe every page from its record."""
    return resolve(read_archives(pages.sparkSession, write_archives(pages)))
