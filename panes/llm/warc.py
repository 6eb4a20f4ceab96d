"""WARC archives compressed with a dictionary, one Zstandard frame a record.

Archive layout (the public WARC/Zstandard convention): a leading skippable frame
holds the dictionary, then each record is a frame of its own, compressed with
it, so that a record can be read alone.  The dictionary is trained on a bounded
sample of what is to be archived and embedded in every archive: pages of any
size count as pieces of ``SAMPLE_BYTES``, of which ``SAMPLE_RECORDS`` are drawn by
hash.  Where that is too little for a dictionary, the archives have an empty one
and a warning is logged.

A task writes the rows of its partition through Spark's text writer, with its
commit protocol, so a lost or repeated task leaves no partial archive, and on any
file system Spark writes to.  The writer sets a line separator after each row; here
it is an empty skippable frame, which every Zstandard reader passes over.

An archive has a bounded size, as it is read back as one row: ``ARCHIVE_ROWS`` frames,
after which the writer begins the next file, and ``ARCHIVE_BYTES`` of them (a longer
record is alone in its archive).  One that is full by its bytes is filled up with
empty frames, so that the next one's dictionary comes first in its file.

Defined results.  Null html is an empty payload.  Of records with equal payloads
of at least ``least`` bytes the one with the largest page id is a response, the
others are revisits that refer to it; a null id ranks below all others.  Rows
that repeat the largest id are responses too, as are all rows of a group in
which no row has an id.  A null url is left out of the record.  An empty table
gives no records.  Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import logging
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, small_side, write_table

#: Pieces of pages, and bytes of a piece, that a dictionary is trained on at most.
SAMPLE_RECORDS, SAMPLE_BYTES = 400, 32 << 10
DICTIONARY_BYTES = 64 << 10
#: Frames (with the dictionary's) and bytes of records of an archive.
ARCHIVE_ROWS, ARCHIVE_BYTES = 4096, 32 << 20
#: Frame numbers of the Zstandard format and of the WARC convention (fixed values).
FRAME, DICTIONARY, SKIP_FIRST, SKIP_LAST = 0xFD2FB528, 0x184D2A5D, 0x184D2A50, 0x184D2A5F
#: An empty skippable frame, as text: it stands between records.
SEPARATOR = struct.pack("<II", SKIP_FIRST, 0).decode()
DATE = "2024-01-01T00:00:00Z"


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False, date: str = DATE) -> bytes:
    """A WARC/1.1 record: a response with its payload, or a revisit without."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = lambda page: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    own = f"{page_id}:{url}:{digest}"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {name(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, own)}>'}",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {name(refers_to)}", f"Refers-To-Page-ID: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record, its payload and whether the payload has the stated digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: the payload doesn't have its digest")
    return fields | {"payload": payload, "payload_bytes": length, "digest": digest}


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends (RFC 8878, 3.1.1)."""
    flags = data[at + 4]
    single = flags >> 5 & 1
    at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
    last = False
    while not last:
        header = int.from_bytes(data[at:at + 3], "little")
        last, kind, size = header & 1, header >> 1 & 3, header >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + 4 * (flags >> 2 & 1)


def records(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, uncompressed."""
    import zstandard

    data, at = memoryview(archive), 0
    reader = zstandard.ZstdDecompressor()
    while at < len(data):
        number = struct.unpack_from("<I", data, at)[0]
        if SKIP_FIRST <= number <= SKIP_LAST:
            size = struct.unpack_from("<I", data, at + 4)[0]
            if number == DICTIONARY and size:
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[at + 8:at + 8 + size])))
            at += 8 + size
        elif number == FRAME:
            end = frame_end(data, at)
            yield reader.decompress(bytes(data[at:end]))
            at = end
        else:
            raise ValueError(f"no frame begins at byte {at}")


def train(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of the pages, pieces of long ones; empty, with a warning, if there is too little."""
    import zstandard

    last = F.floor((F.octet_length("html") - 1) / SAMPLE_BYTES)  # number of a page's last piece
    some = pages.select("page_id", "url", "html").filter(F.octet_length("html") > 0)
    total = some.agg(F.sum(last + 1)).first()[0] or 0
    share, payload = 1 << 40, F.col("html").cast("binary")
    drawn = F.filter(F.sequence(F.lit(0).cast("long"), last),
                     lambda k: F.pmod(F.xxhash64("page_id", "url", k), F.lit(share)) < int(min(1, SAMPLE_RECORDS / max(total, 1)) * share))
    # Pieces are cut inside the row: a long page isn't repeated for each of its own.
    pieces = F.transform(drawn, lambda k: F.substring(payload, (k * SAMPLE_BYTES + 1).cast("int"), F.lit(SAMPLE_BYTES)))
    sample = some.select("page_id", "url", F.explode(pieces)).limit(SAMPLE_RECORDS).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [record(r[0], r[1], bytes(r[2])) for r in sample]).as_bytes()
    except zstandard.ZstdError as e:
        logging.getLogger(__name__).warning("no dictionary: %d pieces of pages are too little to train on (%s)", len(sample), e)
        return b""


def write_archives(pages: DataFrame, path: str, least: int = 1000, archive_rows: int = ARCHIVE_ROWS,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write every row of ``pages`` (page_id, url, html) as a record of an archive under ``path``."""
    spark = pages.sparkSession
    ship_package(spark)
    dictionary = spark.sparkContext.broadcast(train(pages))
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("payload"), F.unhex(F.sha1(html)).alias("digest"))
    ids = write_table(rows.select("page_id", "digest", F.octet_length("payload").alias("size")), "payload-digests")
    copies = ids.filter(F.col("size") >= least).groupBy("digest").agg(
        F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1 and response is not null")
    copies = write_table(copies.select("digest", "response"), "payload-copies")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("response")), F.lit(False)) & F.col("response").isNotNull()
    roles = rows.join(small_side(copies), "digest", "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("response")).alias("refers_to"), revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        trained = dictionary.value
        compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        first = struct.pack("<II", DICTIONARY, len(trained)) + trained
        empty = SEPARATOR.encode()
        frames, waiting, rows, size = [], 0, archive_rows, 0  # rows and bytes of the archive being written
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                frame = compressor.compress(record(*row))
                if rows == archive_rows or rows > 1 and size + len(frame) > archive_bytes:
                    frames += [empty] * (archive_rows - rows) + [first]
                    rows, size = 1, 0
                frames.append(frame)
                rows, size, waiting = rows + 1, size + len(frame), waiting + len(frame)
                if waiting > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])
                    frames, waiting = [], 0
        if frames:
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])

    archives = roles.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    archives.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", archive_rows).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``: record_type, page_id, url,
    payload (empty for revisits), payload_bytes, payload_digest (hex) and refers_to."""
    ship_package(spark)
    schema = "record_type string, page_id long, url string, payload binary, payload_bytes long, payload_digest string, refers_to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_type", "page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for content in batch.column(0):
                out, size = [], 0
                for raw in records(content.as_py()):
                    r = parse(raw)
                    out.append((r["WARC-Type"], number(r.get("Page-ID")), r.get("WARC-Target-URI"), r["payload"], r["payload_bytes"],
                                r["digest"], number(r.get("Refers-To-Page-ID"))))
                    size += len(r["payload"])
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)
