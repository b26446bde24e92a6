"""Content-addressed WARC archive.

Pages are written as WARC files (``write_warc``), the files are read back record by record (``read_warc``), the records go
into a content-addressed store (``write_store``): payload bytes once per SHA-256, exact record headers separately. ``read_store``
joins both again, so that every original record can be rebuilt byte by byte (``rebuild``).

Null handling: a NULL html is an empty payload, a NULL url an empty target. Records without page id are never the original of
a record that has one; rows that repeat a page id and its payload are all ``response``. Other columns of pages are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, stage

#: Fixed values of the WARC format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "1970-01-01T00:00:00Z"
#: Records in one archive file; a reader holds one file in memory.
RECORDS_PER_FILE = 2000

RECORD = (
    "file string, offset long, record_type string, record_id string, refers_id string, header binary, http binary, "
    "payload binary, sha1 string, sha256 string"
)
FIELDS = pa.schema([
    (f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in RECORD.split(", ")
])


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 hexadecimal digits, ten at a time, give 32 letters."""
    digest = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def write_warc(pages: DataFrame, folder: str) -> None:
    """Write one WARC record per page: ``response``, or ``revisit`` without payload where a smaller page id has the same bytes.

    The digests of repeated payloads, with the smallest page id of each, are counted with map-side combining and staged; the
    pages meet them by a join that moves no page unless that table is large, and then may be split at a hot digest.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", "html", F.sha2(body, 256).alias("sha256"))
    repeated = stage(
        keyed.select("page_id", "sha256").groupBy("sha256")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n"),
        "digests",
    )
    rows = keyed.join(repeated, "sha256", "left").withColumn(
        "again", F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    )
    payload = F.coalesce(F.col("html"), F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit(END),
    )
    block = F.concat(http, F.when(F.col("again"), F.lit("")).otherwise(payload))
    name = F.coalesce(F.col("page_id").cast("string"), F.concat(F.lit("none-"), F.col("sha256")))
    header = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.when(F.col("again"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name,
        F.lit(">\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " "),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"), base32_sha1(payload.cast("binary")),
        F.when(F.col("again"), F.concat(
            F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("first_id").cast("string"),
            F.lit(f">\r\nWARC-Profile: {REVISIT_PROFILE}"),
        )).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END),
    )
    (
        rows.select(F.concat(header, block).alias("value")).write
        .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)
    )


def split_records(data: bytes) -> Iterator[tuple[int, bytes, dict[str, str], bytes]]:
    """(offset, exact header, its fields in lower case, block) of each record of an archive file's bytes."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at) + 4
        header = data[at:stop]
        fields = {}
        for line in header.decode("utf-8", "surrogateescape").split("\r\n")[1:]:
            key, colon, value = line.partition(":")
            if colon:
                fields[key.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        if data[stop + length : stop + length + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is not ended by two line breaks")
        yield at, header, fields, data[stop : stop + length]
        at = stop + length + 4


def _parser(with_payload: bool):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows = [_record(path.as_py(), *parts, with_payload) for parts in split_records(data)]
                yield pa.RecordBatch.from_pylist([dict(zip(FIELDS.names, r, strict=True)) for r in rows], schema=FIELDS)

    return parse


def _record(path: str, offset: int, header: bytes, fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    http, mark, payload = block.partition(b"\r\n\r\n")
    kind, named = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        sha1, sha256, payload = named, None, None
    else:
        sha1, sha256 = b32encode(hashlib.sha1(payload).digest()).decode(), hashlib.sha256(payload).hexdigest()
        if named and named != sha1:
            raise ValueError(f"the payload at byte {offset} of {path} does not have the digest in its header")
    return (
        path, offset, kind, fields["warc-record-id"], fields.get("warc-refers-to"), header, http + mark,
        payload if with_payload else None, sha1, sha256,
    )


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of WARC files (plain, or gzip as a whole), whose payloads have been checked against the digest in the header."""
    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select("path", "content")
    return files.mapInArrow(_parser(with_payload), RECORD)


def write_store(spark: SparkSession, archive: str, folder: str) -> None:
    """Take WARC files into ``headers`` (exact header bytes, a row per record) and ``payloads`` (bytes once per SHA-256).

    A record without payload finds its SHA-256 by the SHA-1 in its header; two payloads with one SHA-1 end the job. Equal
    payloads are merged in each task before they are shuffled.
    """
    records = stage(read_warc(spark, archive, with_payload=False).drop("payload"), "records")
    digests = stage(
        records.filter("sha256 is not null").groupBy("sha1")
        .agg(F.min("sha256").alias("sha256"), F.max("sha256").alias("other"))
        .select("sha1", F.when(F.col("sha256") == F.col("other"), F.col("sha256")).otherwise(
            F.raise_error(F.concat(F.lit("two payloads have the SHA-1 "), F.col("sha1")))).alias("sha256")),
        "digests",
    )
    records.drop("sha256").join(digests, "sha1", "left").write.parquet(f"{folder}/headers")
    whole = read_warc(spark, archive).filter("sha256 is not null")
    whole.groupBy("sha256").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{folder}/payloads")


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every record with its payload, joined on the SHA-256, which is computed anew and has to be the payload's key.

    ``payload_bytes`` and ``payload_digest`` are computed once per payload before the join; a query that does not ask for
    ``payload`` moves none.
    """
    payloads = spark.read.parquet(f"{folder}/payloads").select(
        "sha256", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.sha2("payload", 256) == F.col("sha256"), base32_sha1(F.col("payload"))).otherwise(
            F.raise_error(F.concat(F.lit("a payload does not have the digest "), F.col("sha256")))).alias("payload_digest"),
    )
    return spark.read.parquet(f"{folder}/headers").join(payloads, "sha256", "left")


def rebuild(stored: DataFrame) -> DataFrame:
    """The exact bytes of each record as it stood in its archive file: ``file, offset, record``."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return stored.select("file", "offset", F.concat("header", "http", body, F.lit(END.encode())).alias("record"))


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages written as WARC files, stored by content and read back; ``page_id`` and ``refers_to`` come from the headers."""
    folder = new_folder(spark, "warc")
    write_warc(pages, f"{folder}/files")
    write_store(spark, f"{folder}/files", f"{folder}/store")
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1)
    return read_store(spark, f"{folder}/store").withColumns({
        "page_id": F.nullif(number("record_id"), F.lit("")).cast("long"),
        "refers_to": F.nullif(number(F.coalesce("refers_id", F.lit(""))), F.lit("")).cast("long"),
    })
