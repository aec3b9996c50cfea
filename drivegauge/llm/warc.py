"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Writing: Spark's text writer, whose line separator is the record separator, writes plain WARC files into the shared
folder, so a lost executor's files are written again by Spark's own commit protocol. Which pages revisit which is
decided on digests alone; the decisions are stored first, so Spark broadcasts them only where their measured size
allows, and otherwise joins by sorting.

Reading: each task lists, for every magic of an archive behind an empty line that parses as a record header, the record's
offset and its successor's. A payload may hold such a header too. Pointer jumping from offset 0 marks what the chain of
successors reaches, in as many rounds as the logarithm of the number of candidates; only those are records, and only
their payloads are hashed. A chain that ends elsewhere than at the end of its file raises an error: nothing is dropped
silently. An archive is one row of Spark's binary file source, so a page is limited to 2 GB with its headers.

Cases: lengths and ids beyond 64 bits in a payload are no records' and no error; null html is the empty payload; null ids and urls are allowed; rows that repeat the largest page_id of a
payload all stay responses; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import materialize, scratch_dir

END = "\r\n\r\n"
MAGIC = re.compile(rb"(?:\A|(?<=\r\n\r\n))WARC/1\.[01]\r\n")
LENGTH = re.compile(rb"\r\nContent-Length: (\d+)(?=\r\n)")
KIND = re.compile(rb"\r\nWARC-Type: ")
DIGITS = 18  # more digits than a file can have bytes; ids of more are none of a 64-bit column
DATE = "2024-01-01T00:00:00Z"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, record_offset long"
#: Bytes of payload in an archive, at most (a larger page has one of its own), and of a page in the archives of many.
ARCHIVE, PAGE = 128 << 20, 64 << 10


def revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``page_id, digest, refers_to`` of each page whose payload, of ``least`` bytes or more, a larger page_id has too."""
    keys = materialize(pages.filter(F.octet_length("html") >= least).select("page_id", F.unhex(F.sha1("html")).alias("digest"), F.octet_length("html").alias("size")), "warc-keys")
    groups = keys.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    found = keys.join(groups, ["digest", "size"]).filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return materialize(found.select("page_id", "digest", "refers_to").distinct(), "warc-revisits")


def write_archives(df: DataFrame, path: str, least: int = 1000, archive: int = ARCHIVE, page: int = PAGE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record per row, in files of at most ``archive`` bytes of payload or one record.

    Pages of up to ``page`` bytes share files of a fixed number of records; larger ones are written apart, by the size
    of the largest.
    """
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    known = revisits(pages, least).select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to")
    keyed = pages.withColumn("sha1", F.sha1("html")).withColumn("size", F.octet_length("html"))
    joined = keyed.join(known, keyed["page_id"].eqNullSafe(known["r_id"]) & (F.unhex("sha1") == known["r_digest"]), "left")
    again = F.col("r_digest").isNotNull()
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END))
    block = F.when(again, F.lit("")).otherwise(F.concat(http, F.col("html")))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name,
        F.lit(f"WARC-Date: {DATE}\r\nWARC-Target-URI: "), F.regexp_replace("url", "[\\r\\n]+", " "),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.lit("\r\nWARC-Payload-Length: "), F.col("size"),
        F.when(again, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block), F.lit(END),
    )
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    for name, part, size in (("pages", F.col("size") <= page, page), ("large", F.col("size") > page, largest)):
        if name == "pages" or largest > page:
            joined.filter(part).select(F.concat(header, block).alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", max(1, archive // size)).text(f"{path}/{name}")


def _number(value: bytes | None) -> int | None:
    found = re.search(rb"(-?\d{1,19})>?$", value) if value else None
    number = int(found[1]) if found else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def candidates_in(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and successor of all that reads as a record's header behind a record's end, within the file.

    A header reaches to the next empty line, and none of two can begin within the other, so this takes time in
    proportion to the file whatever its payloads hold. Payloads are not looked at.
    """
    starts, successors = [], []
    for found in MAGIC.finditer(content):
        stop = content.find(b"\r\n\r\n", found.end() - 2)
        length = LENGTH.search(content, found.end() - 2, stop + 2) if stop >= 0 else None
        if length and KIND.search(content, found.end() - 2, stop + 2) and len(length[1]) <= DIGITS:
            successor = stop + 4 + int(length[1]) + 4
            if successor <= len(content):
                starts.append(found.start())
                successors.append(successor)
    return np.array(starts, np.int64), np.array(successors, np.int64)


def record(content: bytes, start: int, successor: int) -> tuple:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of a record of the chain."""
    body = content.find(b"\r\n\r\n", start) + 4
    fields = dict(line.split(b": ", 1) for line in content[start : body - 4].split(b"\r\n") if b": " in line)
    kind = fields[b"WARC-Type"].decode("utf-8", "replace")
    if kind == "response":
        cut = content.find(b"\r\n\r\n", body, successor - 4)
        payload = memoryview(content)[cut + 4 : successor - 4] if cut >= 0 else b""
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:
        size = _number(fields.get(b"WARC-Payload-Length"))
        digest = fields.get(b"WARC-Payload-Digest", b"").decode("utf-8", "replace").removeprefix("sha1:")
    return _number(fields.get(b"WARC-Record-ID")), size, digest, kind, _number(fields.get(b"WARC-Refers-To"))


def reachable(starts: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """Which of the sorted ``starts`` the chain from offset 0 reaches, by pointer jumping."""
    n = len(starts)
    at = np.searchsorted(starts, successors)
    jump = np.where((at < n) & (starts[np.minimum(at, n - 1)] == successors), at, n)
    jump = np.r_[jump, n]  # n stands for the end of the file, and for the dead ends of false candidates
    seen = np.zeros(n + 1, bool)
    seen[0] = n > 0 and starts[0] == 0
    for _ in range(max(1, n.bit_length())):
        seen[jump[np.flatnonzero(seen)]] = True
        jump = jump[jump]
    return seen[:n]


def records_in(archive: str, content: bytes) -> pa.RecordBatch:
    """The records that the chain from the file's start reaches; it has to end where the file ends."""
    starts, successors = candidates_in(content)
    kept = reachable(starts, successors)
    starts, successors = starts[kept].tolist(), successors[kept].tolist()
    if (successors[-1] if successors else 0) != len(content):
        raise ValueError(f"{archive}: the chain of records breaks at offset {successors[-1] if successors else 0}")
    rows = [(*record(content, a, z), archive, a) for a, z in zip(starts, successors, strict=True)]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [c.split()[0] for c in RECORDS.split(", ")])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of each record, with its archive and offset."""

    def scan(batches):
        for batch in batches:
            for archive, content in zip(*batch.columns, strict=True):
                yield records_in(archive.as_py(), content.as_py())

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter("length > 0").select("path", "content")
    return files.mapInArrow(scan, RECORDS)


def round_trip(df: DataFrame, least: int = 1000, **columns: str) -> DataFrame:
    """Writes the archives to the shared folder and reads them back."""
    path = scratch_dir(df.sparkSession, "warc")
    write_archives(df, path, least, **columns)
    return read_archives(df.sparkSession, path)
