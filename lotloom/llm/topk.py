"""Exact top-k search by columnar branch-and-bound (operator 1).

Queries and candidates are cut into blocks of bounded size, and each meeting of a query
block with a candidate block is one group. Inside, vectors lie dimension by dimension.
Inner products grow one block of dimensions at a time; after each, a candidate can gain
at most |rest of query| * |rest of candidate|, and candidates that cannot pass a query's
k-th best score any more leave its list. Groups return k rows for each query at most,
which are merged in two steps.

A first, small round seeds the bound: each query meets SEEDS candidates, and its k-th
best score among these goes with it to every block, which so prunes from its first candidate on.

Search is exact, so work is queries times candidates; the blocks spread it evenly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotloom.session import Scratch

#: Vectors in a block of queries and of candidates; queries and candidates looked at at once.
QUERY_BLOCK, CANDIDATE_BLOCK, STRIPE, CHUNK = 8192, 16384, 512, 4096
#: Candidates of the first round.
SEEDS = 2048
#: Dimensions added between two prunings.
STEP = 16
#: Scores are 64-bit; what lies beyond counts as the end of that range.
LEAST, MOST = -(2**63), 2**63 - 1


def search(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int, floor: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of each query's k best of x, best first, ties to the smaller id; equal ids don't meet.

    ``floor`` (float, NaN for none) holds a score for each query that k candidates somewhere are known to
    reach: smaller ones may be left out. Values are integers. They are summed as floating point
    numbers wide enough to hold every partial sum exactly, or as Python integers beyond that.
    """
    order = np.argsort(x_ids, kind="stable")
    x_ids, n, dims = x_ids[order], len(x_ids), q.shape[1]
    largest = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * max(dims, 1)
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else object
    q, cols = q.astype(kind), np.ascontiguousarray(x[order].T.astype(kind))  # vertical layout
    cuts = [*range(0, dims, STEP), dims] if dims else [0]
    tail = lambda m, c: np.sqrt((m[c:].astype(np.float64) ** 2).sum(0))
    q_rest, x_rest = [tail(q.T, c) for c in cuts[1:]], [tail(cols, c) for c in cuts[1:]]
    best_s: list = [np.zeros(0, kind) for _ in q_ids]
    best_i: list = [np.zeros(0, np.int64) for _ in q_ids]
    # a later id with an equal score comes after, so it must pass; an id of another block may come before, so equal is enough.
    # The slack covers the bound's rounding; of scores beyond 2 ** 53 it grows with them.
    slack = 1e-3 if kind is not object else largest * 1e-12
    for a in range(0, n, CHUNK):
        b = min(a + CHUNK, n)
        for low in range(0, len(q_ids), STRIPE):
            some = q[low : low + STRIPE]
            head = some[:, cuts[0] : cuts[1]] @ cols[cuts[0] : cuts[1], a:b] if dims else np.zeros((len(some), b - a), kind)
            for i in range(low, low + len(some)):
                least = float(best_s[i][-1]) if len(best_s[i]) == k else -math.inf
                if floor is not None and not math.isnan(floor[i]):
                    least = max(least, float(floor[i]) - slack)
                part, at = head[i - low], np.flatnonzero(x_ids[a:b] != q_ids[i])
                if least > -math.inf and dims:
                    at = at[(part + q_rest[0][i] * x_rest[0][a:b] * (1 + 1e-6) + slack > least)[at]]
                part = part[at]
                for j in range(1, len(cuts) - 1):
                    if not len(at):
                        break
                    part = part + q[i, cuts[j] : cuts[j + 1]] @ cols[cuts[j] : cuts[j + 1], a + at]
                    if least > -math.inf:
                        live = part + q_rest[j][i] * x_rest[j][a + at] * (1 + 1e-6) + slack > least
                        at, part = at[live], part[live]
                if len(at):
                    part = np.minimum(np.maximum(part, LEAST), MOST) if kind is object else part
                    s, ids = np.concatenate([best_s[i], part]), np.concatenate([best_i[i], x_ids[a + at]])
                    top = np.lexsort((ids, -s))[:k] if len(s) <= 4 * k or kind is object else _top(s, ids, k)
                    best_s[i], best_i[i] = s[top], ids[top]
    return list(zip(best_i, best_s))


def _top(s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    least = np.partition(s, len(s) - k)[len(s) - k]
    at = np.flatnonzero(s >= least)
    return at[np.lexsort((ids[at], -s[at]))[:k]]


FOUND = "query_id long, vec_id long, score long"


def _block(k: int):
    def run(group: pa.Table) -> pa.Table:
        side, ids = group.column("side").to_numpy(), group.column("id").to_numpy()
        floor = group.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
        vectors = group.column("vector").combine_chunks()
        flat, size = vectors.flatten().to_numpy(), np.diff(np.asarray(vectors.offsets))
        begin = np.cumsum(size) - size
        out = [(np.zeros(0, np.int64),) * 3]
        for n in np.unique(size[side == 0]).tolist():  # vectors of different lengths don't meet
            rows = [np.flatnonzero((side == s) & (size == n)) for s in (0, 1)]
            q, x = (flat[begin[r][:, None] + np.arange(n)] for r in rows)
            if len(x):
                for query, (found, s) in zip(ids[rows[0]].tolist(), search(q, ids[rows[0]], x, ids[rows[1]], k, floor[rows[0]])):
                    out.append((np.full(len(found), query), found, s.astype(np.int64)))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    return run


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best other vectors.

    ``vectors`` has vec_id and embedding (numbers). Components become
    floor(scale * component) as double; the score is the inner product of these. Rows with
    a null id, a null vector, or null or non-finite components take no part. Vectors of
    different lengths don't meet. Fewer than k candidates give fewer rows, ties go to the
    smaller vec_id. Components and scores beyond 64 bits count as the end of that range.
    Rows that share a vec_id are one vector, the least of them in order of components, which asks if
    one of them does. Further columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(spark, "topk")
    parts = F.col("embedding").cast("array<double>")
    sound = F.coalesce(F.forall(parts, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    whole = F.transform(parts, lambda v: F.floor(v * scale)).cast("array<long>")
    rows = vectors.where(F.col("vec_id").isNotNull() & sound).select(F.col("vec_id").cast("long").alias("id"), whole.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = scratch.write(rows, "vectors")
    n, asking, different = rows.agg(F.count("*"), F.count_if("asks"), F.count_distinct("id")).first()
    if different < n:
        rows = scratch.write(rows.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks")), "merged")
        n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    q_blocks, x_blocks = math.ceil(asking / QUERY_BLOCK) or 1, math.ceil(n / CANDIDATE_BLOCK) or 1
    spread = F.xxhash64("id", F.lit(7))
    upto = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asks = rows.where("asks").select("id", "vector", F.lit(0).alias("side"), F.pmod(spread, F.lit(q_blocks)).cast("int").alias("i"), F.lit(None).cast("double").alias("floor"))
    met = rows.select("id", "vector", F.lit(1).alias("side"), upto(q_blocks).alias("i"), F.lit(None).cast("double").alias("floor"), F.pmod(spread, F.lit(x_blocks)).cast("int").alias("j"))
    if x_blocks > 1:
        few = met.where(F.pmod(F.xxhash64("id", F.lit(8)), F.lit(max(n // SEEDS, 1))) == 0).drop("j")
        seeds = asks.unionByName(few).groupBy("i").applyInArrow(_block(k), FOUND)
        seeds = scratch.write(seeds.groupBy(F.col("query_id").alias("id")).agg(F.min("score").cast("double").alias("floor"), F.count("*").alias("n")).where(F.col("n") == k).select("id", "floor"), "seeds")
        asks = asks.drop("floor").join(seeds, "id", "left").select("id", "vector", "side", "i", "floor")
    # a query goes to every candidate block, a candidate to every query block: a grid of bounded groups
    found = asks.withColumn("j", upto(x_blocks)).unionByName(met).groupBy("i", "j").applyInArrow(_block(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
