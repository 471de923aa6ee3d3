"""Web archives compressed record by record with a dictionary of their own.

An archive is a file of Zstandard frames: first a skippable frame (magic 0x184D2A5D) that
holds the dictionary, itself compressed, then a ``warcinfo`` record and the others, each in
a frame of its own, so that any record can be read from its offset alone.  The dictionary
is built from the records of the archive it stands in.  Of records with equal payloads one
is a ``response`` and the others are ``revisit`` records without payload.

Tasks write archives through Spark's own writer, so a lost task's files never show; an
empty skippable frame, which readers pass over, is the writer's line end.  Only rows whose
payload occurs twice are shuffled, and of each group of equals only one payload is.

Defined cases: a null payload counts as empty; a null id is the least of all and comes back
as null; of repeated rows (equal id and payload) one is the response; a null address has no
``WARC-Target-URI``, and one with line ends or other signs that a header can't hold is
percent-encoded; an archive of few or tiny records, from which no dictionary can be built,
has none; a payload larger than an archive gets an archive of its own; an empty table gives
no archive; columns other than the three named play no part.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexquarry.llm._bloom import may_hold
from lexquarry.llm._skew import join_groups
from lexquarry.scratch import save

#: Bytes of records, before compression, that end an archive; the whole of it is held by its task.
ARCHIVE_BYTES = 32 << 20
#: Bytes of a dictionary, and of the records, evenly spread over the archive, that it is built from.
DICTIONARY_BYTES, SAMPLE_BYTES = 1 << 16, 8 << 20
LEVEL = 3
SUFFIX = ".warc.zst"

# Magic numbers of frames, names and profiles of the two public formats.
_DICTIONARY_MAGIC, _SKIP_MAGIC, _FRAME_MAGIC = 0x184D2A5D, 0x184D2A50, 0xFD2FB528
_VERSION = "WARC/1.1"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty skippable frame, as text: what stands after each archive.
_LINE_END = struct.pack("<II", _SKIP_MAGIC, 0).decode("ascii")

_ROW = "key long, url string, payload string, size long, sha1 string, copy long, refers boolean, refers_to long, refers_url string, refers_copy long"
RECORD = "key long, url string, record_id string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, archive string, offset long"


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _record_id(key: int | None, url: str | None, sha1: str, copy: int | None) -> str:
    """``copy`` tells equal rows apart."""
    name = "\n".join(("" if x is None else str(x)) for x in (key, copy, sha1, url))
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=5)}>"


def _headed(first: str, headers: dict[str, object], block: bytes) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in headers.items() if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _target(url: str | None) -> str | None:
    return None if url is None else quote(url, safe="%!#$&'()*+,/:;=?@[]~|{}^`\"<>\\")


def warc_record(row: dict, date: str) -> bytes:
    """The bytes of a response or a revisit."""
    sha1 = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    headers = {
        "WARC-Type": "revisit" if row["refers"] else "response",
        "WARC-Record-ID": _record_id(row["key"], row["url"], row["sha1"], row["copy"]),
        "WARC-Date": date,
        "WARC-Target-URI": _target(row["url"]),
        "WARC-Payload-Digest": f"sha1:{sha1}",
        "Content-Type": "application/http; msgtype=response",
        "Lexquarry-Key": row["key"],
    }
    if row["refers"]:
        headers |= {"WARC-Profile": _REVISIT_PROFILE, "WARC-Refers-To": _record_id(row["refers_to"], row["refers_url"], row["sha1"], row["refers_copy"]), "WARC-Refers-To-Target-URI": _target(row["refers_url"]), "Lexquarry-Refers-To-Key": row["refers_to"]}
    return _headed(_VERSION, headers, http if row["refers"] else http + (row["payload"] or "").encode()) + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the archive's records, or None where they are too few or too small."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records[::step], k=1024, d=8)
    except zstandard.ZstdError:
        return None


def archive(records: list[bytes], date: str) -> bytes:
    """One archive: the dictionary's frame, and a frame for each record."""
    found = build_dictionary(records)
    compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=found, write_checksum=True).compress if found else zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
    name = hashlib.sha256(b"".join(hashlib.sha256(r).digest() for r in records)).digest()[:16]
    info = _headed(_VERSION, {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.UUID(bytes=name, version=5)}>", "WARC-Date": date, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n") + b"\r\n\r\n"
    out = []
    if found:
        held = zstandard.ZstdCompressor(level=19).compress(found.as_bytes())
        out.append(struct.pack("<II", _DICTIONARY_MAGIC, len(held)) + held)
    return b"".join([*out, compress(info), *map(compress, records)])


def _writer(date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for b in batches:
            for i in range(b.num_rows):
                held.append(warc_record({name: b.column(k)[i].as_py() for k, name in enumerate(b.schema.names)}, date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.record_batch([pa.array([archive(held, date)], pa.binary())], names=["content"])
                    held, size = [], 0
        if held:
            yield pa.record_batch([pa.array([archive(held, date)], pa.binary())], names=["content"])

    return run


def _typed(pages: DataFrame, key: str, url: str, payload: str, least: int) -> DataFrame:
    """The rows of ``_ROW``: what each record is, and which one a revisit refers to."""
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload"), "digest": F.sha2("payload", 256)}).withColumn("hash", F.xxhash64("digest"))
    repeated = save(rows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64("digest").alias("hash")), "repeated")
    among = may_hold(repeated, "hash")("hash")
    nothing = {"copy": F.lit(None).cast("long"), "refers": F.lit(False), "refers_to": F.lit(None).cast("long"), "refers_url": F.lit(None).cast("string"), "refers_copy": F.lit(None).cast("long")}
    names = [x.strip().split()[0] for x in _ROW.split(",")]
    alone = rows.where(~among).withColumns(nothing).select(names)
    equals = save(rows.where(among).drop("hash").withColumn("copy", F.monotonically_increasing_id()), "equals")
    small, equals = equals.where(F.col("size") < least), equals.where(F.col("size") >= least)
    first = save(equals.groupBy("digest").agg(F.max(F.struct("key", "copy", "url")).alias("first"), F.count("*").alias("n")), "first")
    responses = first.select(F.col("first.copy").alias("copy"))
    asked = may_hold(responses.select(F.xxhash64("copy").alias("hash")), "hash")(F.xxhash64("copy"))
    kept = small.unionByName(equals.where(asked).join(responses, "copy", "left_semi")).withColumns({k: v for k, v in nothing.items() if k != "copy"}).select(names)
    again = join_groups(equals.drop("payload"), first, ["digest"], "n").where(F.col("copy") != F.col("first.copy"))
    again = again.select("key", "url", F.lit(None).cast("string").alias("payload"), "size", "sha1", "copy", F.lit(True).alias("refers"), F.col("first.key").alias("refers_to"), F.col("first.url").alias("refers_url"), F.col("first.copy").alias("refers_copy"))
    return alone.unionByName(kept).unionByName(again.select(names))


def write_archives(pages: DataFrame, folder: str, key: str, url: str, payload: str, least: int = 0, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record of every row to archives in ``folder``, which must not be there yet.

    Payloads of ``least`` bytes or more are written once: of rows with equal ones, the row with the greatest
    ``key`` is the response, and the others revisit it.
    """
    spark = pages.sparkSession
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    made = _typed(pages, key, url, payload, least).mapInArrow(_writer(date, archive_bytes), "content binary")
    made.select(F.col("content").cast("string").alias("value")).write.option("lineSep", _LINE_END).option("maxRecordsPerFile", 1).text(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [f.getPath() for f in fs.listStatus(path(folder)) if f.getPath().getName().startswith("part-")]
    for i, part in enumerate(sorted(parts, key=lambda p: p.getName())):
        if not fs.rename(part, path(f"{folder}/records-{i:06d}{SUFFIX}")):
            raise OSError(f"could not rename {part}")


def _magic(content: memoryview, at: int) -> int:
    return struct.unpack_from("<I", content, at)[0]


def frames(content: bytes, piece: int = 1 << 14) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every frame that is not to be skipped."""
    view, at = memoryview(content), 0
    use = zstandard.ZstdDecompressor()
    while at < len(view):
        began = at
        if _magic(view, at) & 0xFFFFFFF0 == _SKIP_MAGIC:
            size = struct.unpack_from("<I", view, at + 4)[0]
            if at == 0 and _magic(view, at) == _DICTIONARY_MAGIC:
                held = bytes(view[8 : 8 + size])
                held = use.decompress(held) if _magic(memoryview(held), 0) == _FRAME_MAGIC else held
                use = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
            at += 8 + size
            continue
        one, parts = use.decompressobj(), []
        while not one.eof:
            if at >= len(view):
                raise ValueError(f"the frame at {began} is cut off")
            part = view[at : at + piece]
            parts.append(one.decompress(part))
            at += len(part) - len(one.unused_data)
        yield began, b"".join(parts)


def _headers(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def parse(record: bytes) -> tuple | None:
    """Key, address, id, type, key referred to, bytes, digest and payload of a response or revisit, checked against its own digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    h = _headers(head)
    if h["WARC-Type"] not in ("response", "revisit"):
        return None
    block = rest[: int(h["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {h['WARC-Record-ID']} has another length than it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_headers(http)["Content-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:")
    own = h["WARC-Type"] == "response"
    if own and (size != len(payload) or digest != _sha1(payload)):
        raise ValueError(f"record {h['WARC-Record-ID']} has another payload than its digest says")
    number = lambda k: int(h[k]) if k in h else None
    return number("Lexquarry-Key"), h.get("WARC-Target-URI"), h["WARC-Record-ID"], h["WARC-Type"], number("Lexquarry-Refers-To-Key"), size, digest, payload if own else None


def _reader(payloads: bool, batch_bytes: int = 4 << 20):
    names = [x.strip().split()[0] for x in RECORD.split(",")]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        rows: list[tuple] = []
        held = 0
        for b in batches:
            for path, content in zip(b.column(0), b.column(1), strict=True):
                name = path.as_py()
                for at, record in frames(content.as_buffer()):
                    found = parse(record)
                    if found is None:
                        continue
                    rows.append((*(found if payloads else (*found[:-1], None)), name, at))
                    held += 200 + (len(record) if payloads else 0)
                    if held >= batch_bytes:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)

    return run


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The responses and revisits of all archives in ``folder``, with the columns of ``RECORD``; addresses as they were written.

    Every response is unpacked and held against its digest; ``payloads`` says whether they are also given back.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder)
    return files.select("path", "content").mapInArrow(_reader(payloads), RECORD)
