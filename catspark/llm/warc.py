"""WARC archives (operator 3): dictionary-compressed records.

Each archive is a sequence of Zstandard frames.  The first is a skippable frame
(magic 0x184D2A5D) that holds a dictionary built from the archive's own
records; then comes one frame per record, compressed with it, so that a record
can be read alone.  A skippable frame of one byte closes each record: Spark's
text writer ends every row with a line feed, which is that byte.  Writing
through Spark gives any file system Spark can write, and its commit protocol:
a task that ran twice leaves one archive.
"""

from __future__ import annotations

import hashlib
import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_path
from .common import parts_for, ship

DICT_MAGIC, SKIP_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0x184D2A50, 0xFD2FB528
#: bytes of samples per byte of dictionary, as Zstandard recommends; more only takes longer
SAMPLE_RATIO = 100
CLOSE = struct.pack("<II", SKIP_MAGIC, 1)  # its one byte is the row's line feed
#: fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
          "record_type string, refers_to long")


def plan_records(pages: DataFrame, min_bytes: int = 100, id_col: str = "page_id",
                 url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, html (null for revisits), payload_bytes, payload_digest, refers_to.

    Of pages with equal payloads of at least ``min_bytes`` that with the
    smallest page_id is the response (all its rows, should the id be repeated);
    the others revisit it.  Rows with a null id are always responses.  Null
    html is an empty payload.
    """
    body = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), body.alias("html"),
                        F.octet_length(body).cast("long").alias("payload_bytes"),
                        F.sha2(body, 256).alias("payload_digest"))
    # slim rows decide; the payloads are moved once, by page, to their archives
    slim = rows.where(F.col("payload_bytes") >= min_bytes).select("page_id", "payload_digest")
    first = materialise(slim.groupBy("payload_digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1).drop("n"), "first")
    # both sides are read from files, so that Spark can split the rows of a hot payload
    revisits = materialise(slim.join(first, "payload_digest")
                           .where(F.col("page_id") != F.col("refers_to"))
                           .select("page_id", "payload_digest", "refers_to").distinct(),
                           "revisits")
    out = rows.join(revisits, ["page_id", "payload_digest"], "left")
    return out.withColumn("html", F.when(F.col("refers_to").isNull(), F.col("html")))


def write_warc(pages: DataFrame, path: str, archive_bytes: int = 32 << 20,
               dict_bytes: int = 64 << 10, level: int = 6, **columns) -> str:
    """Write one record per page into archives of about ``archive_bytes`` of payload.

    An archive's dictionary is built from its own records; where they are too
    few or too small for that, their first bytes serve as a raw dictionary.
    Empty table: a folder without records.
    """
    ship(pages.sparkSession)
    records = plan_records(pages, **columns)
    html = columns.get("html_col", "html")
    total = pages.agg(F.sum(F.octet_length(html))).first()[0]
    dealt = records.repartition(parts_for(total, archive_bytes), F.xxhash64("page_id", "url"))

    def compress(batches):
        import pyarrow as pa
        import zstandard
        blocks = [record(r) for b in batches for r in b.to_pylist()]  # one archive
        if not blocks:
            return
        params = zstandard.ZstdCompressionParameters.from_level(level, write_checksum=True)
        book = build_dictionary(blocks, dict_bytes)
        packer = zstandard.ZstdCompressor(dict_data=book, compression_params=params)
        data = book.as_bytes()
        head = struct.pack("<II", DICT_MAGIC, len(data)) + data
        for i in range(0, len(blocks), 256):
            frames = [packer.compress(x) + CLOSE for x in blocks[i:i + 256]]
            frames[0] = head + frames[0]
            head = b""
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])

    frames = dealt.mapInArrow(compress, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.text(path, lineSep="\n")
    return path


def build_dictionary(blocks: list[bytes], size: int):
    """A dictionary from records spread evenly over the archive, SAMPLE_RATIO times its size."""
    import zstandard
    total = sum(map(len, blocks))
    spread = blocks[::max(1, total // (SAMPLE_RATIO * size))]
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 10)), spread)
    except zstandard.ZstdError:  # too few samples
        raw = b"".join(b[:2048] for b in blocks[:16])[-size:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def record(row: dict) -> bytes:
    """A WARC record: response with the payload, or revisit of the one it refers to."""
    revisit = row["refers_to"] is not None
    url = "".join(c for c in (row["url"] or "") if c not in "\r\n")
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<urn:page:{row['page_id']}>"),
              ("WARC-Target-URI", url),
              ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
              ("X-Payload-Length", row["payload_bytes"])]
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n".encode()
    body = http + (b"" if revisit else row["html"].encode())
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:page:{row['refers_to']}>"),
                   ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", len(body))]
    head = "".join([f"{VERSION}\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"])
    return head.encode() + body + b"\r\n\r\n"


def frame_end(data: bytes, at: int) -> int:
    """End of the Zstandard frame at ``at``: its header, blocks and checksum."""
    import zstandard
    head = bytes(data[at:at + 18])
    checksum = 4 if zstandard.get_frame_parameters(head).has_checksum else 0
    at += zstandard.frame_header_size(head)
    last = 0
    while not last:
        word = int.from_bytes(data[at:at + 3], "little")
        last, kind, size = word & 1, word >> 1 & 3, word >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + checksum


def archived_records(data: bytes):
    """The decompressed records of one archive."""
    import zstandard
    view, at, unpacker = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic == DICT_MAGIC:
            book = zstandard.ZstdCompressionDict(bytes(view[at + 8:at + 8 + size]))
            unpacker = zstandard.ZstdDecompressor(dict_data=book)
        if magic == FRAME_MAGIC:
            end = frame_end(view, at)
            yield unpacker.decompress(view[at:end])
            at = end
        else:  # skippable
            at += 8 + size


def parse(block: bytes) -> tuple:
    """A RECORD row; digest and length of a response are taken from its payload."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = body[:int(fields["Content-Length"])]
    payload = body.partition(b"\r\n\r\n")[2]
    number = lambda x: None if x == "None" else int(x)
    page = number(fields["WARC-Record-ID"][10:-1])
    if fields["WARC-Type"] == "revisit":
        return (page, fields["WARC-Target-URI"], None, int(fields["X-Payload-Length"]),
                fields["WARC-Payload-Digest"].removeprefix("sha256:"), "revisit",
                number(fields["WARC-Refers-To"][10:-1]))
    return (page, fields["WARC-Target-URI"], payload, len(payload),
            hashlib.sha256(payload).hexdigest(), "response", None)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived record; an archive is read by one task (its size is bounded
    by the writer), different archives by different tasks."""
    def parse_all(batches):
        import pyarrow as pa
        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in RECORD.split(", ")]
        for b in batches:
            for data in b.column("content"):
                rows = []
                for block in archived_records(data.as_py()):
                    rows.append(parse(block))
                    if len(rows) == 500:
                        yield _batch(rows, names, types)
                        rows = []
                if rows:
                    yield _batch(rows, names, types)

    def _batch(rows, names, types):
        import pyarrow as pa
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse_all, RECORD)


def warc_digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder, read the archives back, one row per record."""
    return read_warc(spark, write_warc(pages, scratch_path(spark, "warc"))).drop("payload", "url")
