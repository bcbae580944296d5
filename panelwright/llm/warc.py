"""WARC archives: write monolithic gzip files, normalise them to one member per record.

Archives are first written by Spark's text writer as whole-file gzip streams.
The normaliser inflates such a stream once, front to back, compresses every
record as a gzip member of its own and returns a sidecar index of the members'
places, with which any record can be read alone.
"""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_SCHEMA = "archive string, offset long, length long, record_id string, record_type string"
RECORD_SCHEMA = ("record_id string, record_type string, url string, refers_to string, "
                 "payload_digest string, payload_bytes long, payload binary")
#: Fixed values of the formats: base-32 digits by value, as conv() and as RFC 4648 write them.
DIGITS_CONV, DIGITS_RFC = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20
OUT_BYTES = 8 << 20


def base32(sha1_hex: Column) -> Column:
    """Upper-case base 32 of 40 hex digits: each 10 of them are 8 digits of 5 bits."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), DIGITS_CONV, DIGITS_RFC)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, record_type, refers_to for rows (page_id, url, html).

    Of equal payloads of at least ``min_bytes`` bytes the row with the largest
    page_id is the response, the others revisit it; smaller payloads are all
    responses.  A null html is an empty payload.  A null page_id is smaller than
    any other; rows that share the largest page_id are all responses, and so is a
    group with null ids only.

    The largest id per digest is combined before the shuffle.  Only digests that
    occur again come back, and the left join's large partitions (one payload may
    hold a third of the rows) are split by adaptive execution.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    pages = pages.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    large = F.octet_length("payload") >= min_bytes
    again = (pages.where(large).groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
             .where("n > 1 AND largest IS NOT NULL").drop("n"))
    joined = pages.join(again, "digest", "left")
    revisits = large & F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select("page_id", "url", "payload", base32(F.col("digest")).alias("digest"),
                         F.when(revisits, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisits, F.col("largest")).alias("refers_to"))


def record_text(date: str = "2000-01-01T00:00:00Z") -> Column:
    """One WARC record without the blank lines that end it, from with_revisits() columns.

    A revisit keeps the HTTP header, with the length of the payload it leaves out.
    Control characters and blanks in a url are percent-encoded by their place.
    """
    lines = lambda *xs: F.concat(*[F.concat(x if isinstance(x, Column) else F.lit(x), F.lit("\r\n")) for x in xs])
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8",
                 F.concat(F.lit("Content-Length: "), F.octet_length("payload").cast("string")), "")
    revisit = F.col("record_type") == "revisit"
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    header = lines(
        "WARC/1.1", F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))), F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")))
    refers = F.when(revisit, lines(F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to"))),
                                   F.lit(f"WARC-Profile: {PROFILE}"))).otherwise("")
    size = lines("Content-Type: application/http;msgtype=response",
                 F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")), "")
    return F.concat(header, refers, size, block)


def write_monolithic(records: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Archives of one gzip stream per file; the line separator writes the end of each record.

    The files follow the partitions of ``records``; pages are moved once, for
    their revisits, and not again for even archives.
    """
    (records.select(record_text().alias("value")).write
     .option("compression", "gzip").option("lineSep", "\r\n\r\n")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_header(raw: bytes) -> dict[str, str]:
    """Named fields of a WARC or HTTP header, names in lower case."""
    fields = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields


def inflated(stream) -> Iterator[bytes]:
    """The content of a gzip file in pieces of bounded size, whether of one member or of many."""
    left = b""
    member = zlib.decompressobj(wbits=31)
    while data := left or stream.read(CHUNK):
        yield member.decompress(data, CHUNK)
        left = member.unconsumed_tail
        if member.eof:
            left = member.unused_data
            member = zlib.decompressobj(wbits=31)


def records_of(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record with its closing blank lines) in order.

    Holds one record and one piece at a time.  Raises ValueError where the stream
    ends inside a record or is no WARC record.
    """
    pieces, held = iter(pieces), bytearray()

    def want(size: int) -> bool:
        while len(held) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while want(1):
        end, seen = -1, 0
        while end < 0:
            end = held.find(b"\r\n\r\n", max(0, seen - 3))
            seen = len(held)
            if end < 0 and not want(seen + 1):
                raise ValueError("the stream ends inside a record's header")
        if not held.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = parse_header(bytes(held[:end]))
        total = end + 4 + int(fields["content-length"]) + 4
        if not want(total):
            raise ValueError("the stream ends inside a record's block")
        yield fields, bytes(held[:total])
        del held[:total]


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every ``*.gz`` archive under ``source``; returns the index rows of the new ones.

    One row per record: archive (path of the new file), offset and length of the
    record's gzip member, record id and type.  The caller writes them as the
    sidecar.  Files are dealt over tasks by path; a task streams one file at a
    time through bounded pieces.  A file is written under a name of its own and
    then renamed, so that a repeated task leaves the same bytes under the same
    name.  An empty folder or archive gives no rows.

    Both folders must be on a file system that pyarrow reaches by its URI (local
    or mounted, hdfs, s3, gs): Spark has no writer for binary files.
    """
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out_fs, folder = arrow_fs.FileSystem.from_uri(target)
        out_fs.create_dir(folder, recursive=True)
        for path in (p for frame in frames for p in frame["path"]):
            in_fs, place = arrow_fs.FileSystem.from_uri(path)
            name = place.rsplit("/", 1)[-1].partition(".")[0] + ".warc.gz"
            part = f"{folder}/_{uuid.uuid4().hex}"
            rows, offset = [], 0
            with in_fs.open_input_stream(place, compression=None) as stream, out_fs.open_output_stream(part, compression=None) as out:
                for fields, record in records_of(inflated(stream)):
                    member = gzip.compress(record, 6, mtime=0)
                    out.write(member)
                    rows.append((f"{target}/{name}", offset, len(member), fields.get("warc-record-id", ""),
                                 fields.get("warc-type", "")))
                    offset += len(member)
            out_fs.move(part, f"{folder}/{name}")
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX_SCHEMA.split(", ")])

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return paths.repartition(tasks, "path").mapInPandas(rewrite, INDEX_SCHEMA)


def read_records(index: DataFrame) -> DataFrame:
    """Records at the places that an index names, each read by itself.

    payload is null for a revisit; payload_digest and payload_bytes are then those
    of the payload it refers to, from its headers.  Output goes in batches of a
    bounded number of bytes.
    """
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def one(stream, offset: int, length: int) -> tuple:
        stream.seek(offset)
        raw = gzip.decompress(stream.read(length))
        head, _, block = raw[:-4].partition(b"\r\n\r\n")
        fields = parse_header(head)
        http, _, payload = block.partition(b"\r\n\r\n")
        revisit = fields["warc-type"] == "revisit"
        size = int(parse_header(http)["content-length"]) if revisit else len(payload)
        return (fields["warc-record-id"], fields["warc-type"], fields.get("warc-target-uri"),
                fields.get("warc-refers-to"), fields["warc-payload-digest"].removeprefix("sha1:"), size,
                None if revisit else payload)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, places in frame.groupby("archive", sort=False):
                files, place = arrow_fs.FileSystem.from_uri(archive)
                with files.open_input_file(place) as stream:
                    rows, size = [], 0
                    for offset, length in zip(places["offset"], places["length"], strict=True):
                        rows.append(one(stream, int(offset), int(length)))
                        size += rows[-1][5]
                        if size >= OUT_BYTES:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=names)

    return index.mapInPandas(read, RECORD_SCHEMA)


def page_number(record_id: Column) -> Column:
    """The page_id in a record id that record_text() wrote; null for a page without one."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
