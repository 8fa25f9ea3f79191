"""Importance resampling towards a target distribution (operator 12).

Features of a text are its runs of up to ``max_n`` words. Arrow kernels find them: ascii_lower,
split_pattern_regex, list_flatten and dictionary_encode turn a batch of texts into indices of different words;
shifted indices form longer runs, each different pair of a run and its next word gets its CRC
by carrying on that of the run, and buckets of features are CRCs modulo the number of buckets.

Three steps: bucket counts of both tables, summed in the task before they are shuffled (at most one row a
bucket and task); gains of the buckets, a table of bounded size; weights of the documents by
``take`` and a segmented sum. Scores are weights with Gumbel noise from a digest of doc_id, so the highest scores
are a draw without replacement. Ranks come from a sort by ranges: a row's rank is its place
in its range plus the sizes of the ranges before, so nothing is sorted in one task.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.llm.textvec import slices
from lotloom.session import Scratch, small_batches, small_table

#: Words are runs of a-z (after lower-casing), 0-9 and everything beyond ASCII; this is what lies between them.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, MOST_BUCKETS = 10_000, 1 << 20
#: Bytes of text looked at at once.
PART_BYTES = 1 << 21


def features(col: pa.Array, max_n: int, buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """How many words each text has and, for runs of 1, 2, ... words, the row and the bucket of each run, in order."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(col, "")), BETWEEN)
    words, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.not_equal(words, "")  # a text that begins or ends between words has an empty part there
    encoded = words.filter(some).dictionary_encode()
    row = row.filter(some).to_numpy(zero_copy_only=False)
    written = encoded.dictionary.cast(pa.binary()).to_pylist()
    word = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.bincount(row, minlength=len(col)).astype(np.int64)
    crc = np.fromiter(map(zlib.crc32, written), np.int64, len(written))
    run, found = word, [(row, crc[word] % buckets)]
    for n in range(2, max_n + 1):
        if len(word) < n:
            found.append((row[:0], word[:0]))
            continue
        pairs, longer = np.unique(run[: len(word) - n + 1] * len(written) + word[n - 1 :], return_inverse=True)
        before, last = (v.tolist() for v in np.divmod(pairs, len(written)))
        crc = np.fromiter((zlib.crc32(b" " + written[w], c) for c, w in zip(crc[before].tolist(), last)), np.int64, len(pairs))
        run, inside = longer, row[: len(word) - n + 1] == row[n - 1 :]
        found.append((row[: len(inside)][inside], crc[run[inside]] % buckets))
    return counts, found


def _counted(max_n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0), PART_BYTES):
                for _, bucket in features(batch.column(0).slice(a, b - a), max_n, buckets)[1]:
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """How often the features of all texts fall into each bucket: bucket, n; buckets without any have no row."""
    counted = texts.select(F.col("text").cast("string")).mapInArrow(_counted(max_n, buckets), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket: a thousand times the logarithm of how much likelier the target's features fall into it, one added to each count, rounded down."""
    s, t = (np.zeros(buckets, np.int64) for _ in range(2))
    for out, counted in ((s, source), (t, target)):
        for row in counted.collect():  # at most one row a bucket
            out[row["bucket"]] = row["n"]
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s.astype(float).tolist(), t.astype(float).tolist())], np.int64)


def _weighed(gain: np.ndarray, max_n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(gain)
        for batch in batches:
            for a, b in slices(batch.column(1), PART_BYTES):
                words, found = features(batch.column(1).slice(a, b - a), max_n, len(gain))
                size, total = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                for row, bucket in found:
                    per = np.bincount(row, minlength=b - a)
                    won = np.append(0, np.cumsum(table.take(pa.array(bucket)).to_numpy(zero_copy_only=False)))
                    ends = np.cumsum(per)
                    size, total = size + per, total + won[ends] - won[ends - per]
                weight = total // np.maximum(size, 1)  # rounds down
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, (words, size, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """A thousand times a Gumbel variate, rounded down, from 32 bits of a digest of seed and doc_id; a null doc_id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(spark: SparkSession, scored: DataFrame, eligible: Column, most: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... by falling score, equal ones by doc_id (null first), of the first ``most`` eligible rows; else null.

    ``scored`` must be cheap to read, since ranges are found by a pass of their own. Rows equal in score and
    doc_id get different ranks in any order and don't stay together, so they make no hot range.
    """
    scratch = Scratch(spark, "ranks")
    own = scratch.write(scored.withColumns({"_in": eligible, "_tie": F.monotonically_increasing_id()}), "tied")
    order = [F.col("_in").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("_tie")]
    sorted_ = own.repartitionByRange(*order).sortWithinPartitions(*order)
    places = scratch.write(sorted_.withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "sorted")
    offsets, before = [], 0
    for part, n in sorted((r["_part"], r["count"]) for r in places.groupBy("_part").count().collect()):  # one row a range
        offsets.append((part, before))
        before += n
    at = F.col("_before") + F.col("_pos") + 1
    out = places.join(F.broadcast(small_table(spark, offsets, "_part int, _before long")), "_part")
    return out.select(*scored.columns, F.when(F.col("_in") & (at <= most), at).alias("rank"))


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, share: int = 10, max_n: int = 1, buckets: int = BUCKETS, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """Each document with n_words, n_features, weight, score and its rank among the ``share`` percent drawn (null if it isn't).

    ``docs`` (doc_id, text) and ``target`` (text) are counted whole. Documents of fewer than ``least_words``
    words are counted and scored, too, but never drawn. A null or empty text has no words and weight 0.
    Repeated rows are documents of their own with equal scores. Further columns are ignored; an empty table
    gives no rows, an empty target leaves all buckets to the added ones.
    """
    if not 0 < buckets <= MOST_BUCKETS or not 0 <= share <= 100 or max_n < 1:
        raise ValueError("buckets, share or max_n out of bounds")
    small_batches(spark)
    gain = gains(bucket_counts(docs, max_n, buckets), bucket_counts(target, max_n, buckets), buckets)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weighed = texts.mapInArrow(_weighed(gain, max_n), "doc_id long, n_words long, n_features long, weight long")
    scored = Scratch(spark, "resample").write(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    enough = F.col("n_words") >= least_words
    return ranked(spark, scored, enough, share * scored.where(enough).count() // 100)
