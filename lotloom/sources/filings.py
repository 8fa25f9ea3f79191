"""Reading filings: text files, archives of them, tables and databases."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.functions import text

#: Members of an archive that are read: a lock-in circular and a shareholding pattern.
MEMBER = r"(?i)(^|/)(CML\d+|SHP[_-][^/]+)(_java|_pdfplumber)?\.(txt|pdf)$"


def exchange_of(path: Column) -> Column:
    """BSE or NSE by the folder that a path lies in."""
    low = F.lower(F.regexp_replace(path, r"\\", "/"))
    return F.when(low.contains("/bse/"), "BSE").when(low.contains("/nse/"), "NSE")


def kind_of(path: Column) -> Column:
    low = F.lower(F.regexp_replace(path, r"\\", "/"))
    return F.when(low.contains("/notices/"), "notice").when(low.contains("/shp/"), "shp").otherwise("lockin")


def read_texts(spark: SparkSession, path: str, glob: str = "*_java.txt", lenient: bool = False) -> DataFrame:
    """A row per text file below ``path``: doc_id (a hash of the path), exchange, kind, code, symbol, path, text.

    ``lenient`` puts a mark in the place of bytes that aren't UTF-8. Empty files are rows with an empty text.
    """
    if lenient:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
        rows = files.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    else:
        files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
        rows = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    name = F.substring_index("path", "/", -1)
    pdf = F.regexp_replace(name, r"(_java|_pdfplumber)?\.txt$", ".pdf")
    rows = rows.withColumns({"exchange": exchange_of(F.col("path")), "kind": kind_of(F.col("path"))})
    code, symbol = text.file_identity(pdf, F.col("exchange"))
    shp = F.nullif(F.regexp_extract(pdf, r"^SHP[-_](.+)\.pdf$", 1), F.lit(""))
    annexure = F.regexp_extract(pdf, r"^\d+-(.+)-Annexure-II\.pdf$", 1)
    return rows.select(F.xxhash64("path").alias("doc_id"), "exchange", "kind", code.alias("code"), F.coalesce(symbol, shp, F.nullif(annexure, F.lit(""))).alias("symbol"), "path", text.plain_breaks(F.col("text")).alias("text"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import re

    wanted, names = re.compile(MEMBER), ["archive", "member", "content", "error"]
    row = lambda *values: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.string(), pa.string(), pa.binary(), pa.string()))], names=names)
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            try:
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    for n in sorted(n for n in z.namelist() if wanted.search(n)):
                        yield row(path, n, z.read(n), None)
            except (zipfile.BadZipFile, NotImplementedError, RuntimeError) as e:  # no archive, an unknown method, a password
                yield row(path, "", None, str(e))


def read_zips(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """The lock-in and shareholding files inside archives: archive, member, content, error.

    One member is held at a time, besides the archive itself, which must fit a task's memory. An archive
    that can't be read gives one row with an empty member and its error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(_members, "archive string, member string, content binary, error string")


def read_database(spark: SparkSession, url: str, name: str, column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A table over JDBC, read in ranges of ``column`` where bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if column and bounds:
        reader = reader.option("partitionColumn", column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()


#: A text of fewer characters is doubtful.
FEW_CHARS = 100


def text_states(found: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """``found`` (key) with what is to be done for its text: ``needed`` where there is none or an empty one, and ``doubtful`` where a text is there
    but has next to no characters. Of several texts of a key the longest counts; a null key has no text."""
    longest = texts.groupBy(key).agg(F.max(F.length("text")).alias("_n"))
    n = F.coalesce("_n", F.lit(0))
    return found.join(longest, key, "left").withColumns({"needed": n == 0, "doubtful": (n > 0) & (n < FEW_CHARS)}).drop("_n")


def first_notice(codes: DataFrame, notices: DataFrame) -> DataFrame:
    """For each code the text of its first notice by path (file names start with the code)."""
    rows = notices.withColumn("code", F.regexp_extract(F.substring_index("path", "/", -1), r"^(\d+)-", 1))
    return codes.join(rows.groupBy("code").agg(F.min_by("text", "path").alias("notice_text")), "code", "left")


def pattern_file(lockins: DataFrame, listing: DataFrame) -> DataFrame:
    """Each lock-in file with the first of its shareholding candidates that exists."""
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.txt$", "")
    tries = lockins.select("path", F.posexplode(text.shp_candidates(stem)).alias("place", "name"))
    found = tries.join(listing.select(F.substring_index("path", "/", -1).alias("name"), F.col("path").alias("shp_path")), "name")
    return lockins.join(found.groupBy("path").agg(F.min_by("shp_path", F.struct("place", "shp_path")).alias("shp_path")), "path", "left")
