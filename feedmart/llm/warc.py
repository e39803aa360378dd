"""WARC archives with resolved revisits.

``write`` turns pages into response records, shuffles their headers (digest and page id) by payload digest, keeps per
digest the page with the largest id as the response, and writes archives with fresh headers in which
the others are revisit records without payload. Payloads stay where they are read, but for those of a digest with copies (told by a
bitmap of fixed size, so now and then one more) where the groups of copies are too many to broadcast. ``read`` parses archives and checks each payload against
its digest; ``resolve`` joins revisits to their responses by digest.

Archives are written by Spark's text writer with its commit protocol into a folder of shared storage: a lost
executor's half-written files never show. A file is one gzip stream of at most RECORDS_PER_FILE records and of at most
ARCHIVE_BYTES of payloads, or of one record with a larger payload. Archives are inflated and parsed piece by piece.

Defined results: a null payload is empty; empty payloads are equal payloads. Repeated rows (same id, same payload)
as the response are responses themselves. A null id counts as the smallest. A null address is replaced by the
record's URN. Control characters and blanks in addresses are percent-encoded. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_rows, join_groups, staged
from .ngram_join import MEMBER_BITS, _members_bitmap

RECORDS_PER_FILE = 4000
ARCHIVE_BYTES = 64 << 20
PIECE_BYTES = 1 << 20
BATCH_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"
# The record format, and its profile of revisits with an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"
EOL = "\r\n"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1; five hexadecimal digits make four base32 digits."""
    digest = F.sha1(payload.cast("binary"))
    quads = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), HEX32, BASE32)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(EOL))


def _address(url: Column, urn: Column) -> Column:
    safe = F.regexp_replace(F.regexp_replace(url, "[\\x00-\\x1F\\x7F]", "%0A"), " ", "%20")
    return F.coalesce(safe, urn)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    return rows.withColumn("digest", sha1_base32(F.col("payload")))


def with_revisits(rows: DataFrame) -> DataFrame:
    """Adds ``original``: the id of the page whose response holds the payload, null for a payload that has no copy."""
    spark = rows.sparkSession
    headers = staged(rows.select("page_id", "digest"), "warc-headers")
    groups = headers.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("copies"))
    groups = staged(groups.filter("copies > 1"), "warc-originals")
    shared = spark.sparkContext.broadcast(_members_bitmap(groups.select(F.col("digest").alias("rep"))))

    @F.pandas_udf("boolean")
    def in_group(at: pd.Series) -> pd.Series:
        at = at.to_numpy()
        return pd.Series((shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1)
    may_have_copies = in_group(F.pmod(F.xxhash64("digest"), F.lit(1 << MEMBER_BITS)))
    nothing = {"original": F.lit(None).cast("long"), "copies": F.lit(None).cast("long")}
    alone = rows.filter(~may_have_copies).withColumns(nothing)
    return alone.unionByName(join_groups(rows.filter(may_have_copies), groups, "digest", "copies", headers.count()))


def record_text(row: DataFrame, date: str = DATE) -> DataFrame:
    """One string per record, headers and block, without the last line feed."""
    urn = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.coalesce(F.col("page_id") != F.col("original"), F.col("original").isNotNull())
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"),
                    _header("Content-Length", F.octet_length("payload")), F.lit(EOL))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    own = F.concat(F.lit(URN), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    head = F.concat(
        F.lit(f"WARC/1.1{EOL}"), _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", urn(F.col("page_id"))), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", _address(F.col("url"), own)), _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(_header("WARC-Refers-To", urn(F.col("original"))), _header("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{EOL}"), _header("Content-Length", F.octet_length(block)), F.lit(EOL))
    return row.select(F.concat(head, block, F.lit("\r\n\r")).alias("value"))


def size_levels() -> list[tuple[int, int, int]]:
    """(least, most, records): payload bytes above ``least`` up to ``most``, and how many such records an archive holds."""
    levels, least, records = [], -1, RECORDS_PER_FILE
    while records > 1:
        levels.append((least, ARCHIVE_BYTES // records, records))
        least, records = ARCHIVE_BYTES // records, records // 4
    return levels + [(least, 1 << 31, 1)]


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = DATE) -> None:
    """Write deduplicated archives into the new folder ``path``, those of each level of payload sizes in a job of their own; only
    the last one marks the folder as complete."""
    plain = records(pages, id_col, url_col, payload_col)
    rows, n_bytes = with_revisits(plain), F.octet_length("payload")
    levels = size_levels()
    level = sum(((n_bytes > least).cast("int") for least, _, _ in levels[1:]), F.lit(0))
    found = sorted({0, *plain.agg(F.collect_set(level)).first()[0]})  # the first job refuses a folder that is there
    for i in found:
        least, most, n = levels[i]
        revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))  # without payload
        part = rows.filter(revisit | (n_bytes <= most)) if i == 0 else rows.filter(n_bytes > least).filter(n_bytes <= most).filter(~revisit)
        (record_text(part, date).write.mode("append" if i else "error").option("lineSep", "\n").option("compression", "gzip")
         .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", n)
         .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(i == found[-1]).lower()).text(path))


def inflate(data):
    """The bytes of an archive in pieces: of all its gzip streams, or as they are."""
    view, at = memoryview(data).cast("B"), 0
    if bytes(view[:2]) != b"\x1f\x8b":
        for at in range(0, len(view), PIECE_BYTES):
            yield view[at:at + PIECE_BYTES]
        return
    while at < len(view):
        stream = zlib.decompressobj(31)
        while not stream.eof:
            given = stream.unconsumed_tail
            if not given:
                given = view[at:at + PIECE_BYTES]
                at += len(given)
            piece = stream.decompress(given, PIECE_BYTES)
            if piece:
                yield piece
            elif not given and not stream.eof:
                raise ValueError("the archive ends inside a gzip stream")
        at -= len(stream.unused_data)


def parse(data):
    """(headers, block) of each record of an archive, given as bytes or in pieces; headers have lower-case names."""
    pieces = iter([data] if isinstance(data, (bytes, bytearray, memoryview)) else data)
    buffer, at, gone = bytearray(), 0, 0  # the next record starts at ``at``, after ``gone`` bytes that were dropped

    def more() -> bool:
        nonlocal at, gone
        piece = next(pieces, None)
        if piece is None:
            return False
        del buffer[:at]
        at, gone = 0, gone + at
        buffer.extend(piece)
        return True

    while at < len(buffer) or more():
        searched = at
        while (end := buffer.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(buffer) - at - 3)
            if not more():
                raise ValueError(f"the headers of the record at byte {gone + at} don't end")
        lines = buffer[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {gone + at}")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n, skip = int(head["content-length"]), end + 4 - at
        while len(buffer) < at + skip + n + 4 and more():
            pass
        start = at + skip
        if buffer[start + n:start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {gone + at} doesn't end where it says")
        with memoryview(buffer) as view:
            block = bytes(view[start:start + n])
        at = start + n + 4
        yield head, block


def _number(urn: str | None) -> int | None:
    digits = (urn or "").strip("<>").removeprefix(URN)
    return int(digits) if digits else None


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records of the archives under ``path``: page_id, url, record_type, payload_digest, payload_bytes (null for
    revisits), refers_to, and the payload if asked for. A payload that doesn't fit its digest fails the job."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
              ("payload_bytes", pa.int64()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payloads
    schema = pa.schema(fields)

    def rows(batches):
        batch = lambda out: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
        for b in batches:
            for data in b.column(0):
                out, held = [], 0
                for head, block in parse(inflate(data.as_buffer())):
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    whole = head["warc-type"] == "response"
                    if whole and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload of {head['warc-record-id']} doesn't fit its digest")
                    out.append((_number(head["warc-record-id"]), head["warc-target-uri"], head["warc-type"], digest,
                                len(payload) if whole else None, _number(head.get("warc-refers-to")), payload if whole else None)[:len(fields)])
                    held += len(payload) * payloads
                    if len(out) == 500 or held >= BATCH_BYTES:
                        yield batch(out)
                        out, held = [], 0
                if out:
                    yield batch(out)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    sql = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    with batch_rows(spark, 1):  # an archive a batch
        return staged(files.mapInArrow(rows, ", ".join(f"{n} {sql[t]}" for n, t in fields)), "warc-records")


def resolve(rows: DataFrame) -> DataFrame:
    """``rows`` of ``read`` with payload_bytes of revisits from the response they refer to, found by digest."""
    rows = rows.drop("payload")
    groups = rows.groupBy(F.col("payload_digest").alias("digest")).agg(
        F.max(F.when(F.col("record_type") == "response", F.col("payload_bytes"))).alias("full_bytes"), F.count("*").alias("copies"))
    groups = staged(groups.filter("copies > 1"), "warc-responses")
    out = join_groups(rows.withColumnRenamed("payload_digest", "digest"), groups, "digest", "copies", rows.count())
    return out.select("page_id", "url", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
                      F.col("digest").alias("payload_digest"), "record_type", "refers_to")


__all__ = ["inflate", "parse", "read", "record_text", "records", "resolve", "sha1_base32", "size_levels", "with_revisits", "write"]
