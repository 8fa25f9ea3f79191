"""Zip archives of filings: members as rows, then their contents, so that work follows members and not archives.

A circular comes as ``CML<number>.zip`` with the lock-in annexure ``CML<number>.pdf`` and the shareholding pattern ``SHP_<symbol>.pdf``.
``members`` reads only the directories at the archives' ends. ``contents`` deals the members it is given over
tasks by size; a task seeks to its members' bytes, so an archive may be larger than any task's memory and
several tasks may read it at once. Archives must lie where pyarrow's file systems reach them.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBERS = "archive string, member string, kind string, symbol string, target string, offset long, packed long, size long, error string"
#: Packed bytes of members that a task reads.
TASK_BYTES = 64 << 20
#: Where archives go that were read.
DONE = "done_extraction"
_SCHEMA = pa.schema([(n, pa.string()) for n in ("archive", "member", "kind", "symbol", "target")] + [(n, pa.int64()) for n in ("offset", "packed", "size")] + [("error", pa.string())])
_UNREADABLE = (zipfile.BadZipFile, NotImplementedError, RuntimeError, OSError, EOFError, pa.ArrowInvalid)  # the last where a file is too short to seek in


def _open(path: str):
    where, name = fs.FileSystem.from_uri(path)
    return where.open_input_file(name)


def wanted(archive: str, infos: list[zipfile.ZipInfo]) -> tuple[list[tuple[str, str, zipfile.ZipInfo]], str | None]:
    """(kind, symbol, member) of an archive's two filings, or why it hasn't got them: the last annexure of its number, the first pattern."""
    number = re.search(r"CML(\d+)\.zip$", archive, re.IGNORECASE)
    if not number:
        return [], "the archive's name is no circular's"
    named = [(i.filename.rsplit("/", 1)[-1], i) for i in infos]
    lockins = [i for base, i in named if re.fullmatch(rf"CML{number[1]}(_java|_pdfplumber)?\.(pdf|txt)", base, re.IGNORECASE)]
    patterns = [(m[1], i) for base, i in named if (m := re.fullmatch(r"SHP[_-](.+?)(?:_java|_pdfplumber)?\.(?:pdf|txt)", base, re.IGNORECASE))]
    if not lockins or not patterns:
        return [], f"no {'annexure' if not lockins else 'shareholding pattern'} inside"
    symbol = re.sub(r'[<>:"/\\|?*]', "", patterns[0][0]).strip()
    if not symbol:
        return [], "the pattern's name has no symbol"
    return [("lockin", symbol, lockins[-1]), ("shp", symbol, patterns[0][1])], None


def _target(kind: str, symbol: str, archive: str, member: str) -> str:
    """The name under which a member is kept."""
    number, tail = re.search(r"CML(\d+)", archive.rsplit("/", 1)[-1], re.IGNORECASE), re.search(r"(?:_java|_pdfplumber)?\.[^.]+$", member)
    return (f"{symbol}-CML{number[1]}" if kind == "lockin" and number else f"SHP-{symbol}") + (tail[0] if tail else "")


def _directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[dict] = []
        for path in batch.column(0).to_pylist():
            try:
                with _open(path) as f, zipfile.ZipFile(f) as z:
                    found, error = wanted(path, z.infolist())
            except _UNREADABLE as e:
                found, error = [], f"can't be read: {e}"
            rows += [{"archive": path, "member": i.filename, "kind": kind, "symbol": symbol, "target": _target(kind, symbol, path, i.filename), "offset": i.header_offset, "packed": i.compress_size, "size": i.file_size} for kind, symbol, i in found]
            rows += [{"archive": path, "error": error}] if error else []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def members(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """The annexure and the pattern of each archive below ``path``, with the name each is to be kept under and its place; an archive without both gives one row that says why."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path").mapInArrow(_directories, MEMBERS)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*_SCHEMA, ("content", pa.binary())])
    for batch in batches:
        for row in batch.to_pylist():
            content = None
            if row["error"] is None:
                try:
                    with _open(row["archive"]) as f, zipfile.ZipFile(f) as z:
                        content = z.read(row["member"])
                except _UNREADABLE as e:
                    row["error"] = f"can't be read: {e}"
            yield pa.RecordBatch.from_pylist([{**row, "content": content}], schema=schema)


def contents(found: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Members with their ``content``, a task for about ``task_bytes`` packed bytes of them. One member is held at a time; one that can't be read has an error instead."""
    total = found.agg(F.coalesce(F.sum("packed"), F.lit(0))).first()[0]
    dealt = found.select(*(f.split()[0] for f in MEMBERS.split(", "))).repartition(max(1, -(-total // task_bytes)), "archive", "offset")
    return dealt.mapInArrow(_contents, f"{MEMBERS}, content binary")


def finished(read: DataFrame, there: DataFrame, now: Column) -> DataFrame:
    """Archives of which all members were read, and where each is to be moved (archive, moved): the folder DONE beside it, with
    the time in its name where ``there`` (path) has a file of that name already."""
    good = read.groupBy("archive").agg(F.max("error").alias("error"), F.count("kind").alias("n")).where("error is null and n > 0").select("archive")
    name, stem = F.substring_index("archive", "/", -1), F.regexp_replace(F.substring_index("archive", "/", -1), r"\.[^.]*$", "")
    folder = F.concat(F.regexp_replace("archive", "[^/]*$", ""), F.lit(f"{DONE}/"))
    plain, dated = F.concat(folder, name), F.concat(folder, stem, F.date_format(now, "_yyyyMMdd_HHmmss"), F.lit(".zip"))
    held = there.select(F.col("path").alias("plain"), F.lit(True).alias("held")).distinct()
    return good.withColumn("plain", plain).join(held, "plain", "left").select("archive", F.when(F.col("held"), dated).otherwise(F.col("plain")).alias("moved"))
