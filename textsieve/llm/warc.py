"""WARC writing and a salvage reader.

Writing: one gzip member per record. Spark's text writer puts the members'
bytes one after another in any store; the "line separator" is an empty gzip
member, so a file is a plain sequence of members. Repeated payloads become
revisit records.

Reading: files come whole (the number of their records and their bytes are
bounded when they are written); a member is unpacked in small pieces, up to a
bound, so a file is read in one pass. A record counts only if its member unpacks, its header parses, its
length fits and its digests hold. After a failed check the reader searches for
the next valid member or version line, recovers the records from there on and
logs the byte gap it left out.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.common import read, write_table
from textsieve.session import ensure_checkpoint_dir

VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
MAGIC = b"\x1f\x8b\x08"
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
MIN_REVISIT_BYTES = 100
#: Files: at most so many records; payloads over ``LARGE`` bytes go to files of their own, so that no file passes ``FILE_BYTES``
#: (a payload over that has a file for itself). Members: the bytes that are fed at once, and that one may unpack to.
RECORDS_PER_FILE, LARGE, FILE_BYTES = 1000, 1 << 20, 1 << 30
PIECE, MAX_MEMBER = 1 << 16, 1 << 31


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One uncompressed record. A revisit's block is the HTTP header alone, which still tells the payload's length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [VERSION.decode(), f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(raw: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at ``at`` and where it ends; ValueError if a check fails."""
    end = raw.find(b"\r\n\r\n", at)
    if not raw.startswith(b"WARC/1.", at) or end < 0:
        raise ValueError("no header")
    lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    head = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("header line")
        head[name.strip().lower()] = value.strip()
    length = head.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise ValueError("content length")
    start, stop = end + 4, end + 4 + int(length)
    if raw[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError("length")
    block = raw[start:stop]
    said = head.get("warc-block-digest", "")
    if said.startswith("sha256:") and hashlib.sha256(block).hexdigest() != said[7:]:
        raise ValueError("block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    full = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
    if head.get("warc-type") == "response":
        own = hashlib.sha256(payload).hexdigest()
        if digest and own != digest:
            raise ValueError("payload digest")
        digest = own
    ident = lambda k: head[k].removeprefix("<urn:page:").removesuffix(">") if k in head else None
    return {"record_id": ident("warc-record-id"), "record_type": head.get("warc-type"), "url": head.get("warc-target-uri"),
            "refers_to": ident("warc-refers-to"), "payload_digest": digest or None,
            "payload_bytes": int(full[1]) if full else len(payload), "payload": payload}, stop + 4


def unpack(data: bytes, at: int, most: int = MAX_MEMBER) -> tuple[bytes, int]:
    """The gzip member that starts at ``at``, unpacked and checked, and where it ends. A member that unpacks to more than
    ``most`` bytes fails like a damaged one."""
    z, view, out, size = zlib.decompressobj(wbits=31), memoryview(data), [], 0
    while not z.eof and at < len(data):
        piece = view[at:at + PIECE]
        at += len(piece)
        out.append(z.decompress(piece, most - size + 1))
        size += len(out[-1])
        if size > most:
            raise ValueError("member too large")
    if not z.eof:
        raise ValueError("member cut short")
    return b"".join(out), at - len(z.unused_data)


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, str]]:
    """``start, end, record, why`` for each record and, with no record, each quarantined gap of ``data``, in order."""
    at, bad, why = 0, None, ""
    while at < len(data):
        found: list[dict] = []
        try:
            if data.startswith(MAGIC, at):
                raw, end = unpack(data, at)
                inner = 0
                while inner < len(raw):
                    rec, inner = parse(raw, inner)
                    found.append(rec)
            else:
                rec, end = parse(data, at)
                found.append(rec)
        except (ValueError, zlib.error) as e:
            if bad is None:
                bad, why = at, str(e)
            # a member whose later record fails still gives its first ones; the member is logged as a gap
            for rec in found:
                yield at, at, rec, ""
            m = START.search(data, at + 1)
            at = m.start() if m else len(data)
            continue
        if bad is not None:
            yield bad, at, None, why
            bad = None
        for rec in found:
            yield at, end, rec, ""
        at = end
    if bad is not None:
        yield bad, len(data), None, why


def with_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                  min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``id, url..., payload, digest, refers_to``: of equal payloads of ``min_bytes`` or more, all but the smallest id
    refer to it. Rows that repeat the smallest id are responses too; null ids refer to the smallest id there is."""
    staged = pages.withColumn("payload", F.coalesce(F.col(payload_col), F.lit("")).cast("binary")).withColumn(
        "digest", F.sha2("payload", 256))
    first = write_table(
        staged.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
        .agg(F.min(id_col).alias("first_id"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("digest").alias("d"), "first_id"))
    # one row per repeated payload; where it is large, both sides are tables and Spark splits a hot digest
    refers = F.when(~F.col(id_col).eqNullSafe(F.col("first_id")), F.col("first_id"))
    return staged.join(first, F.col("digest") == F.col("d"), "left").withColumn("refers_to", refers).drop("d", "first_id")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               date: str = "2000-01-01T00:00:00Z", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record per row of ``pages`` to archive files in the folder ``path``, of any store that Spark writes to.

    A null payload is empty, a null url leaves its header out. An empty table writes no record.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(payload_col).alias("html"))
    rows = with_revisits(pages, "page_id", "html")
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0

    @F.pandas_udf("binary")
    def member(ids: pd.Series, urls: pd.Series, payloads: pd.Series, digests: pd.Series, refers: pd.Series) -> pd.Series:
        none = lambda x: None if x is None or x == "" else x
        return pd.Series([gzip.compress(record(none(i), u, p, d, none(r), date), 6, mtime=0)
                          for i, u, p, d, r in zip(ids, urls, payloads, digests, refers)], dtype=object)

    def write(some: DataFrame, records: int, mode: str):
        (some.select(member(F.col("page_id").cast("string"), "url", "payload", "digest", F.col("refers_to").cast("string"))
                     .cast("string").alias("value"))
         .write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
         .option("maxRecordsPerFile", records).mode(mode).text(path))

    if largest <= LARGE:
        write(rows, records_per_file, "overwrite")
    else:
        big = F.octet_length("payload") > LARGE
        write(rows.where(~big), records_per_file, "overwrite")
        write(rows.where(big), max(1, min(records_per_file, FILE_BYTES // (2 * largest))), "append")


RECORD_SCHEMA = ("path string, start long, end long, gap string, record_id string, record_type string, url string, "
                 "refers_to string, payload_digest string, payload_bytes long, payload binary")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives under ``path``, and a row with ``gap`` (the failed check) for each quarantined byte
    range ``start`` to ``end``. A revisit's payload is empty; its length and digest are those of the full payload."""
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in RECORD_SCHEMA.split(", ")]
    schema = pa.schema(list(zip(names, kinds)))

    def parse_files(batches):
        for batch in batches:
            for where, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for start, end, rec, why in salvage(content.as_py()):
                    row = {"path": where.as_py(), "start": start, "end": end, "gap": why if rec is None else None, **(rec or {})}
                    if not payloads:
                        row.pop("payload", None)
                    rows.append(row)
                    size += len(row.get("payload") or b"")
                    if len(rows) >= 1000 or size > 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse_files, RECORD_SCHEMA)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the archives, read them back: one row per page. Bytes that cannot be read back are an error."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}-warc"
    write_warc(read(spark, sf_dir, "pages"), path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    lost = F.raise_error(F.concat_ws(" ", F.lit("unreadable record in"), "path", F.lit("at byte"), "start", "gap"))
    got = read_warc(spark, path, payloads=False).where(F.when(F.col("gap").isNull(), True).otherwise(lost.cast("boolean")))
    return got.select(F.when(F.col("record_id") != "", F.col("record_id")).cast("long").alias("page_id"), "payload_bytes",
                      "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

QUERIES = {"op5_warc": op5_warc}
ORACLES = {"op5_warc": ORACLE}
