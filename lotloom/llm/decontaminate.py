"""Benchmark decontamination by winnowing (operator 2).

Of every six consecutive five-word grams the one with the least hash is a fingerprint,
so each span of ten words that a document shares with a benchmark item holds a
fingerprint of both. Items of fewer than ten words are one window; for these, grams of
their own length are fingerprints.

1. Fingerprints of the benchmark are a table of hashes, those of the documents rows (text's
   digest, hash, place). They are joined on the hash.
2. A hit is extended: the document's ten-word windows that hold the fingerprint, word by
   word, are joined with the benchmark's windows, so a window counts only if all its words are equal.
3. Overlapping windows become runs of hit words, and the results go back to the documents by digest.

All steps are joins of tables: nothing of the benchmark or the documents reaches the driver
but counts. Equal texts have one digest and are extended once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotloom.llm import joins
from lotloom.llm.joins import attach, unused
from lotloom.llm.textvec import ALNUM, Words, mix, slices
from lotloom.session import Scratch, small_batches

WINDOW, GRAM = 10, 5
#: Grams among which one is kept.
SPAN = WINDOW - GRAM + 1
#: Bytes of a hash and what a hash table adds.
PRINT_BYTES = 32


def winnow(words: Words) -> np.ndarray:
    """Places of the fingerprints: grams that are the least of some SPAN grams in a row of one text."""
    grams = words.grams(GRAM)
    whole = words.whole(WINDOW)
    if not len(whole):
        return whole
    least = grams[whole]
    for j in range(1, SPAN):
        least = np.minimum(least, grams[whole + j])
    kept = np.zeros(len(grams), bool)
    for j in range(SPAN):
        kept[whole[grams[whole + j] == least] + j] = True
    return np.flatnonzero(kept)


def prints(words: Words, short: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of texts: hash, place, and words of the window they stand for (WINDOW or one of ``short``)."""
    at = winnow(words)
    parts = [(words.grams(GRAM)[at] if len(at) else np.zeros(0, np.uint64), at, WINDOW)]
    for n in short:
        whole = words.whole(n)
        parts.append((mix(words.grams(n)[whole] + np.uint64(n)) if len(whole) else np.zeros(0, np.uint64), whole, n))
    sizes = np.concatenate([np.full(len(a), n, np.int32) for _, a, n in parts])
    return np.concatenate([h for h, *_ in parts]), np.concatenate([a for _, a, _ in parts]), sizes


PRINTS = "key binary, found array<struct<hash:long,place:int,n:int>>"


def _prints(short: tuple[int, ...]):
    """Over (key, text): the fingerprints of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                words = Words(batch.column(1).slice(a, b - a), ALNUM)
                hashes, at, n = prints(words, short)
                order = np.argsort(words.row[at], kind="stable")
                hashes, at, n = hashes[order], at[order], n[order]
                offsets = np.searchsorted(words.row[at], np.arange(b - a + 1))
                rows = pa.StructArray.from_arrays([pa.array(hashes.view(np.int64)), pa.array((at - words.first[words.row[at]]).astype(np.int32)), pa.array(n)], names=["hash", "place", "n"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)], names=["key", "found"])

    return run


def _window(words: Words, place: int, n: int) -> str:
    return b" ".join(words.bytes[s:e].tobytes() for s, e in zip(words.start[place : place + n].tolist(), words.end[place : place + n].tolist())).decode("utf-8", "replace")


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over (item_id, text): every window of each item, with the hash of its fingerprints."""
    for batch in batches:
        for a, b in slices(batch.column(1)):
            words = Words(batch.column(1).slice(a, b - a), ALNUM)
            ids, sizes, texts = [], [], []
            for item, first, n in zip(batch.column(0).slice(a, b - a).to_pylist(), words.first.tolist(), words.count.tolist()):
                for i in range(first, first + max(n - WINDOW, 0) + 1 if n else first):
                    ids.append(item)
                    sizes.append(min(n, WINDOW))
                    texts.append(_window(words, i, min(n, WINDOW)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sizes, pa.int32()), pa.array(texts, pa.string())], names=["item_id", "n", "words"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over (key, text, hits): the windows of each text that hold a hit."""
    for batch in batches:
        for a, b in slices(batch.column(1)):
            words = Words(batch.column(1).slice(a, b - a), ALNUM)
            keys, starts, sizes, texts = [], [], [], []
            for r, (key, hits) in enumerate(zip(batch.column(0).slice(a, b - a).to_pylist(), batch.column(2).slice(a, b - a).to_pylist())):
                first, count = int(words.first[r]), int(words.count[r])
                wanted = {(h["place"] - j, h["n"]) for h in hits for j in range(SPAN if h["n"] == WINDOW else 1)}
                for i, n in sorted(w for w in wanted if 0 <= w[0] <= count - w[1]):
                    keys.append(key)
                    starts.append(i)
                    sizes.append(n)
                    texts.append(_window(words, first + i, n))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(texts, pa.string())], names=["key", "start", "n", "words"])


def digest(text: Column) -> Column:
    """What names a text: 16 bytes; null is empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _mean_bytes(df: DataFrame, size: Column) -> int:
    """Mean of ``size`` over the rows, rounded up, and what a hash table adds."""
    return int(df.agg(F.coalesce(F.avg(size), F.lit(0.0))).first()[0]) + 65


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each text of ``docs`` (text) that shares a window: key (its ``digest``), hits (runs of hit words), items.

    Null and empty texts share nothing; items without text, words or id take no part.
    """
    small_batches(spark)
    scratch = Scratch(spark, "decontaminate")
    texts = docs.select(digest(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    windows = scratch.write(items.mapInArrow(_item_windows, "item_id string, n int, words string"), "windows")
    short = tuple(sorted(r["n"] for r in windows.where(F.col("n") < WINDOW).select("n").distinct().collect()))  # fewer than WINDOW rows
    named = items.select(F.lit(b"").alias("key"), "text")
    theirs = scratch.write(named.mapInArrow(_prints(short), PRINTS).select(F.explode("found.hash").alias("hash")).distinct(), "their-prints")
    # 1: fingerprints of both sides meet
    ours = texts.mapInArrow(_prints(short), PRINTS).select("key", F.explode("found").alias("p")).select("key", "p.*")
    if theirs.count() * PRINT_BYTES > joins.BROADCAST_BYTES:
        ours = scratch.write(ours, "our-prints")  # it is counted before it is joined
    met = attach(ours, theirs, ["hash"], ["key", "place"], "left_semi", PRINT_BYTES)
    hits = met.groupBy("key").agg(F.collect_set(F.struct("place", "n")).alias("found"))
    hits = scratch.write(hits, "hits")
    # 2: the windows around each hit, word by word
    near = attach(texts.withColumn("spread", F.monotonically_increasing_id()), hits, ["key"], ["spread"], "inner", _mean_bytes(hits, F.size("found") * 16))
    near = near.groupBy("key").agg(F.first("text").alias("text"), F.first("found").alias("found"))
    near = scratch.write(near.mapInArrow(_near, "key binary, start int, n int, words string"), "near")
    held = scratch.write(windows.groupBy("words").agg(F.collect_set("item_id").alias("items")), "held")
    size = F.octet_length("words") + F.aggregate("items", F.lit(0), lambda n, i: n + F.octet_length(i) + 16)
    equal = scratch.write(attach(near, held, ["words"], ["key", "start"], "inner", _mean_bytes(held, size)), "equal")
    # 3: runs of hit words, and the items found
    before = Window.partitionBy("key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    ends = equal.select("key", "start", (F.col("start") + F.col("n")).alias("end"), "n").distinct()
    fresh = ends.withColumn("fresh", (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
    numbered = fresh.withColumn("run", F.sum("fresh").over(Window.partitionBy("key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("key", "run").agg(F.struct(F.min("start").cast("long").alias("first"), (F.max("end") - 1).cast("long").alias("last")).alias("hit"))
    runs = runs.groupBy("key").agg(F.sort_array(F.collect_list("hit")).alias("hits"))
    names = equal.select("key", F.explode("items").alias("item")).distinct().groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = scratch.write(runs.join(names, "key"), "overlaps")
    scratch.drop("their-prints", "our-prints", "hits", "near", "equal", "held", "windows")
    return found


#: hits: runs of hit words, as places of the first and last word.
RESULT = "n_words long, hits array<struct<first:long,last:long>>, items array<string>"


def _counted(text_at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(text_at)):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(Words(part.column(text_at), ALNUM).count)], schema=schema)

    return run


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with n_words, hits (runs of hit words) and items (ids as strings, sorted).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A null or empty
    text has no words and no hits; items without text, words or id take no part, and
    items that repeat count once. A benchmark without rows hits nothing. Rows of ``docs``
    that repeat stay; all its columns stay but those named n_words, hits or items, which
    are replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    found = overlaps(spark, docs, benchmark)
    docs = docs.drop("n_words", "hits", "items").withColumn("text", F.col("text").cast("string"))
    (key,) = unused([*docs.columns, "n_words", "hits", "items"], "key")
    wanted = type(docs.schema)([*docs.schema.fields, *spark.createDataFrame([], "n_words long").schema.fields])
    counted = docs.mapInArrow(_counted(docs.columns.index("text"), to_arrow_schema(wanted)), wanted).withColumn(key, digest(F.col("text")))
    size = F.size("hits") * 24 + F.aggregate("items", F.lit(0), lambda n, i: n + F.octet_length(i) + 16)
    joined = attach(counted, found.withColumnRenamed("key", key), [key], ["doc_id"], "left", _mean_bytes(found, size))
    kinds = dict(zip(("n_words", "hits", "items"), (f.dataType for f in spark.createDataFrame([], RESULT).schema)))
    none = {c: F.coalesce(F.col(c), F.array().cast(kinds[c])).alias(c) for c in ("hits", "items")}
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), "n_words", none["hits"], none["items"])


def without_overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) that share no window with a benchmark item; columns as they are."""
    found = overlaps(spark, docs, benchmark)
    (key,) = unused(docs.columns, "key")
    kept = attach(docs.withColumn(key, digest(F.col("text"))), found.select(F.col("key").alias(key)), [key], ["doc_id"], "left_anti")
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def summary(found: DataFrame) -> DataFrame:
    """The figures of each document from what ``contamination`` returns."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
