"""WARC archives with boundary-chain verification (operator 5).

Writing: each page is one record. Of pages with equal payloads of at least LEAST_REPEATED
bytes, the one with the smallest page_id is a response that holds the payload; the
others are revisits that refer to it by its record id. Records go through Spark's text sink, so any
file system that Spark writes to will do. Pages are written by classes of size, each with so many
records a file that no archive passes ARCHIVE_BYTES, unless a single page does.

Reading: every place of an archive that bears the magic and a parsable header is a
candidate that names its successor (header end + Content-Length + 4). Pointer jumping
from the file's start doubles the steps it follows in each round and keeps only what is
reachable, so a magic, or a whole record, inside a payload is rejected. A chain that
ends before the file does marks the archive's last record as incomplete.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.session import Scratch

LEAST_REPEATED = 100
ARCHIVE_BYTES = 8 << 20
#: Upper ends of the classes of record sizes (without the last class, which has none), and bytes that a header takes at most besides the url.
CLASSES, HEADER_BYTES = (4 << 10, 64 << 10, 1 << 20), 1 << 10
#: Revisits up to which their originals are broadcast to the pages; more are shuffled.
BROADCAST_ROWS = 32_768
MAGIC = b"WARC/1.1\r\n"
#: Letter by letter, so that the search goes by the line break, which has no case.
_LENGTH = re.compile(rb"\r\n[Cc][Oo][Nn][Tt][Ee][Nn][Tt]-[Ll][Ee][Nn][Gg][Tt][Hh]:[ \t]*(\d+)[ \t]*(?=\r\n)")
_MAGICS = re.compile(re.escape(MAGIC))
#: Lengths beyond this are no lengths.
_MOST = 1 << 60
#: Time of capture in records of pages that have none.
DATE = "2000-01-01T00:00:00Z"

RECORDS = "archive string, offset long, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, payload binary, sound boolean"


def candidates(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the magic with a header, where the block begins, and where the successor would.

    A header ends at the first blank line and has a length in it. Magics, blank lines and lengths are each looked
    for once in all bytes and matched by place, so magics inside payloads cost no search of their own.
    """
    magic = np.array([m.start() for m in _MAGICS.finditer(data)], np.int64)
    if not len(magic):
        return (np.zeros(0, np.int64),) * 3
    blank, first = [], data.find(b"\r\n\r\n")
    while first >= 0:  # they may overlap
        blank.append(first)
        first = data.find(b"\r\n\r\n", first + 2)
    lengths = [(m.start(), min(int(m[1]) if len(m[1]) < 19 else _MOST, _MOST)) for m in _LENGTH.finditer(data)]
    end = np.append(np.array(blank, np.int64), -1)[np.searchsorted(np.array(blank, np.int64), magic)]
    places, values = (np.array([x[i] for x in lengths] + [len(data)], np.int64) for i in range(2))
    at = np.searchsorted(places, magic + len(MAGIC) - 2)
    good = (end >= 0) & (places[at] < end)
    return magic[good], end[good] + 4, end[good] + 8 + values[at][good]


def reachable(start: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Which candidates a chain from place 0 reaches, by pointer jumping."""
    n = len(start)
    kept = np.zeros(n + 1, bool)
    if not n or start[0] != 0:
        return kept[:n]
    at = np.searchsorted(start, successor)
    jump = np.where((at < n) & (start[np.minimum(at, n - 1)] == successor), at, n)  # n: no candidate there
    jump = np.append(jump, n)
    kept[0] = True
    while True:
        more = kept.copy()
        more[jump[np.flatnonzero(kept)]] = True
        if (more == kept).all():
            return kept[:n]
        kept, jump = more, jump[jump]


def _field(header: bytes, name: bytes) -> str | None:
    m = re.search(rb"(?:^|\r\n)" + name + rb":[ \t]*([^\r\n]*)", header, re.IGNORECASE)
    return m[1].decode("utf-8", "replace").strip() if m else None


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def parse(archive: str, data: bytes, payloads: bool = True) -> Iterator[dict]:
    start, block, successor = candidates(data)
    kept = np.flatnonzero(reachable(start, successor))
    for i in kept.tolist():
        header = data[start[i] + len(MAGIC) : block[i] - 4]
        payload = data[block[i] : successor[i] - 4]
        kind, length = _field(header, b"WARC-Type"), _number(_field(header, b"X-Payload-Length"))
        digest = (_field(header, b"WARC-Payload-Digest") or "").removeprefix("sha256:")
        whole = successor[i] <= len(data) and data[successor[i] - 4 : successor[i]] == b"\r\n\r\n"
        if kind != "revisit":
            own = hashlib.sha256(payload).hexdigest()
            whole, digest, length = whole and digest in ("", own), own, len(payload)
        yield {
            "archive": archive, "offset": int(start[i]), "record_type": kind, "page_id": _number(_field(header, b"X-Page-Id")), "url": _field(header, b"WARC-Target-URI"),
            "payload_bytes": length, "payload_digest": digest, "refers_to": _number(_field(header, b"X-Refers-To-Page")), "payload": payload if payloads else None,
            "sound": bool(whole and (i < kept[-1] or successor[i] == len(data))),
        }


def _parsed(schema: pa.Schema, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for r in parse(path.as_py(), content.as_py() or b"", payloads):
                    rows.append(r)
                    held += r["payload_bytes"] or 0
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``. Empty files give none.

    ``sound`` is false where a digest or an end doesn't fit or the chain breaks off.
    Archives must fit a task's memory; the writer rolls them accordingly.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(spark.createDataFrame([], RECORDS).schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(_parsed(schema, payloads), RECORDS)


def _record(html: Column) -> Column:
    line = lambda name, value: F.concat(F.lit(name + ": "), value)  # noqa: E731  null, and left out, where value is
    revisit = F.col("original").isNotNull()
    uuid = lambda c: F.concat(F.lit("<urn:x-record:"), c, F.lit(":"), F.col("digest"), F.lit(">"))  # noqa: E731  equal payloads have one digest
    head = F.concat_ws(
        "\r\n", F.lit(MAGIC.decode().strip()), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", uuid(F.coalesce(F.col("page_id").cast("string"), F.lit("none")))),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " ")), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", uuid(F.col("original").cast("string"))),
        line("X-Page-Id", F.col("page_id").cast("string")), line("X-Refers-To-Page", F.col("original").cast("string")), line("X-Payload-Length", F.octet_length(html).cast("string")),
        F.lit("Content-Type: text/html"), line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.octet_length(html)).cast("string")),
    )
    return F.concat(head, F.lit("\r\n\r\n"), F.when(revisit, F.lit("")).otherwise(html))


def _size_class() -> Column:
    """The class of a page's record by its size, from 0."""
    size = F.octet_length("html") + F.coalesce(F.octet_length("url"), F.lit(0)) + HEADER_BYTES
    out = F.lit(len(CLASSES))
    for c in range(len(CLASSES) - 1, -1, -1):
        out = F.when(size <= CLASSES[c], c).otherwise(out)
    return out


def write_archives(spark: SparkSession, pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) below ``path``.

    A null html is an empty payload, a null url leaves its line out. A row with a null
    page_id is never an original. Rows that repeat both id and payload of an original
    are responses like it. An empty table writes no record. Further columns are ignored.
    """
    scratch = Scratch(spark, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    digest = F.sha2(F.col("html").cast("binary"), 256)
    sizes = scratch.write(pages.select("page_id", digest.alias("digest"), F.octet_length("html").alias("bytes"), _size_class().alias("class")), "digests")
    long = sizes.where(F.col("bytes") >= LEAST_REPEATED)
    first = long.groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("n")).where("n > 1 and original is not null")
    repeats = long.select("page_id", "digest").join(first.select("digest", "original"), "digest").where(~F.col("page_id").eqNullSafe(F.col("original"))).distinct()
    repeats = scratch.write(repeats.select(F.col("page_id").alias("copy"), F.col("digest").alias("same"), "original"), "repeats")
    if repeats.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        repeats = F.broadcast(repeats)
    present = sorted(r["class"] for r in sizes.select("class").distinct().collect()) or [0]  # at most len(CLASSES) + 1
    for i, c in enumerate(present):
        own = pages.where(_size_class() == c).withColumn("digest", digest)
        records = own.join(repeats, F.col("page_id").eqNullSafe(F.col("copy")) & (F.col("digest") == F.col("same")), "left")
        each = max(1, archive_bytes // CLASSES[c]) if c < len(CLASSES) else 1
        records.select(_record(F.col("html")).alias("value")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", each).mode("append" if i else "overwrite").text(path)
    scratch.drop("digests", "repeats")


def archive_pages(spark: SparkSession, pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives (below ``path``, else in the shared folder) and read them back, without payloads."""
    path = path or Scratch(spark, "archives").path("warc")
    write_archives(spark, pages, path)
    return read_archives(spark, path, payloads=False)
