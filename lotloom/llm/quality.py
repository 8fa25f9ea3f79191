"""Quality classifier from weak labels (operator 10).

Overlapping heuristic labellers each vote good, bad or abstain on every document. Votes
of all documents are counted by pattern (at most 3 ** len(LABELLERS) patterns, summed
map-side); expectation-maximisation over the counts estimates how often each labeller
votes what on good and on bad documents, and gives each pattern a posterior. Posteriors
of a bounded sample (SAMPLE_ROWS rows, SAMPLE_BYTES of text) then train a linear scorer
over hashed words, word shapes and repetitions, which scores all documents where they
are read. No human label enters; ``labels.quality`` is only held against the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.llm.textvec import BLANK, Words, mix, slices
from lotloom.session import small_batches, small_table

SAMPLE_ROWS, SAMPLE_BYTES = 5000, 4 << 20
BUCKETS = 1 << 18
ROUNDS = 60

#: Bytes by kind: letters of either case, digits, white space, marks of prose, other ASCII, beyond ASCII.
_KIND = np.full(256, 4, np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 0, 2, 6
_KIND[[9, 10, 11, 12, 13, 32]] = 5
_KIND[[ord(c) for c in ".,;:?!'\"()-"]] = 3
#: For shapes: letters and digits become classes, other bytes stay.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = ord("a"), ord("a"), ord("0"), ord("a")

#: Names of the figures that labellers look at, in the order of ``figures``.
FIGURES = ("words", "odd", "upper", "repeated", "distinct", "short", "prose", "length", "lines", "digits")

#: (figure, bad from, good up to) or, with falling figures, (figure, bad up to, good from).
LABELLERS = (
    ("rising", "odd", 0.06, 0.015),
    ("rising", "upper", 0.4, 0.12),
    ("rising", "repeated", 0.15, 0.03),
    ("falling", "distinct", 0.25, 0.45),
    ("falling", "short", 0.08, 0.2),
    ("rising", "length", 12.0, 8.0),
    ("rising", "lines", 0.3, 0.05),
    ("falling", "words", 2, 12),
    ("falling", "prose", 0.004, 0.012),
    ("rising", "digits", 0.4, 0.1),
)
ABSTAIN, BAD, GOOD = 0, 1, 2
#: Vote rates expected of any labeller on bad and on good documents, counted as so many votes. A labeller
#: knows one kind of bad text: it misses others but seldom accuses a good one.
PRIOR, PRIOR_VOTES = np.array([[0.1, 0.2, 0.7], [0.1, 0.002, 0.898]]), 10
#: An assumption that votes alone can't give: no labeller accuses more than this share of the good
#: documents. Without it a kind of bad text that only one labeller knows is explained away as that labeller's error.
MOST_FALSE = 0.002


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def figures(words: Words) -> np.ndarray:
    """Shares and counts of each text, in the order of FIGURES; zeros for a text without words."""
    rows = len(words.count)
    kind = _KIND[words.buf]
    text = np.repeat(np.arange(rows), np.diff(words.offs))
    by = np.bincount(text * 8 + kind, minlength=rows * 8).reshape(rows, 8).astype(float)
    n = np.maximum(words.count, 1)
    letters = np.maximum(by[:, 0] + by[:, 1], 1)
    size = np.maximum(by.sum(1), 1)
    same = np.zeros(len(words.hash), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    distinct = np.zeros(rows)
    low, high = words.first[:-1].tolist(), words.first[1:].tolist()
    window = 400  # repetition is measured over stretches of this many words, so that long texts compare
    for r in np.flatnonzero(words.count).tolist():
        h, m = words.hash[low[r] : high[r]], 0
        for s in range(0, len(h), window):
            m += len(np.unique(h[s : s + window]))
        distinct[r] = m / len(h)
    length = words.end - words.start
    lines = np.zeros(rows)
    for r in np.flatnonzero(np.bincount(text[words.buf == 10], minlength=rows) > 2).tolist():
        own = words.buf[words.offs[r] : words.offs[r + 1]].tobytes().split(b"\n")
        lines[r] = 1 - len(set(own)) / len(own)
    out = np.stack([
        words.count, by[:, 4] / size, by[:, 1] / letters, np.bincount(words.row[same], minlength=rows) / n, distinct,
        np.bincount(words.row[length <= 3], minlength=rows) / n, by[:, 3] / size, np.bincount(words.row, length, rows) / n, lines, by[:, 2] / size,
    ], axis=1)
    return out * (words.count > 0)[:, None]


def votes(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(LABELLERS)), np.int8)
    for k, (kind, name, bad, good) in enumerate(LABELLERS):
        v = x[:, FIGURES.index(name)]
        out[:, k] = np.where(v >= bad, BAD, np.where(v <= good, GOOD, ABSTAIN)) if kind == "rising" else np.where(v <= bad, BAD, np.where(v >= good, GOOD, ABSTAIN))
    return out


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good for each pattern, and each labeller's vote rates (abstain, bad, good) on (bad, good) documents, by expectation-maximisation."""
    post = np.where((patterns == BAD).any(1), 0.2, 0.9)
    onehot = (patterns[:, :, None] == np.arange(3)).astype(float)
    rates = np.zeros((2, patterns.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - post), counts * post])
        rates = np.einsum("cp,plv->clv", weight, onehot) + PRIOR[:, None] * PRIOR_VOTES
        rates /= rates.sum(2, keepdims=True)
        false = np.minimum(rates[1, :, BAD], MOST_FALSE)
        rates[1] *= ((1 - false) / (1 - rates[1, :, BAD]))[:, None]
        rates[1, :, BAD] = false
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        log = np.log(prior)[:, None] + np.einsum("plv,clv->cp", onehot, np.log(rates))
        post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return post, rates


def accuracies(rates: np.ndarray) -> list[dict]:
    """What was learnt of each labeller: how often it accuses bad and good documents, and how often it abstains from each."""
    return [{"figure": LABELLERS[k][1], "bad_found": float(rates[0, k, BAD]), "good_accused": float(rates[1, k, BAD]), "bad_abstained": float(rates[0, k, ABSTAIN]), "good_abstained": float(rates[1, k, ABSTAIN])} for k in range(rates.shape[1])]


def hashed(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each feature: words, shapes of words, whether a word repeats the one before."""
    shape = np.zeros(len(words.hash), np.uint64)
    if len(shape):
        # a shape: the first three and the last three classes
        cls = _SHAPE[words.buf].astype(np.uint64)
        for j in range(3):
            shape = shape * np.uint64(257) + cls[np.minimum(words.start + j, words.end - 1)]
        for j in range(3):
            shape = shape * np.uint64(257) + cls[np.maximum(words.end - 1 - j, words.start)]
    same = np.zeros(len(words.hash), np.uint64)
    same[1:] = ((words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])).astype(np.uint64) + np.uint64(1)
    salt = np.array([1, 2, 3], np.uint64) << np.uint64(60)
    at = np.concatenate([mix(v ^ s) % np.uint64(BUCKETS) for v, s in zip((words.hash, shape, same), salt)]).astype(np.int64)
    return np.tile(words.row, 3), at


def train(texts: list[str], target: np.ndarray) -> Model:
    """A logistic scorer of mean hashed features, fitted to soft targets. No rows: score one half."""
    model = Model(np.zeros(BUCKETS), 0.0)
    rows_, ats, values, col = [], [], [], pa.array(texts, pa.string())
    for a, b in slices(col):
        words = Words(col.slice(a, b - a), BLANK)
        row, at = hashed(words)
        key, n = np.unique(row * BUCKETS + at, return_counts=True)
        rows_.append(key // BUCKETS + a)
        ats.append(key % BUCKETS)
        values.append(n / words.count[key // BUCKETS])
    if not sum(map(len, ats)):
        return model
    row, at, value = np.concatenate(rows_), np.concatenate(ats), np.concatenate(values)
    uniq, inv = np.unique(at, return_inverse=True)
    rows = len(texts)
    theta = np.zeros(len(uniq) + 1)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, theta[inv] * value, rows) + theta[-1], -30, 30)))
        miss = p - target
        grad = np.append(np.bincount(inv, miss[row] * value, len(uniq)), miss.sum()) + np.append(1e-3 * theta[:-1], 0)
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        theta -= 0.3 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    model.weights[uniq], model.bias = theta[:-1], float(theta[-1])
    return model


def _with(text_at: int, schema: pa.Schema, make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(text_at)):
                part = batch.slice(a, b - a)
                new = make(Words(part.column(text_at), BLANK))
                yield pa.RecordBatch.from_arrays([new.get(f.name) if f.name in new else part.column(f.name) for f in schema], schema=schema)

    return run


def _votes(words: Words) -> dict[str, pa.Array]:
    return {"votes": pa.array(["".join(map(str, v)) for v in votes(figures(words)).tolist()], pa.string())}


def _scores(model: Model):
    def make(words: Words) -> dict[str, pa.Array]:
        row, at = hashed(words)
        x = np.bincount(row, model.weights[at], len(words.count)) / np.maximum(words.count, 1) + model.bias
        x[words.count == 0] = -30  # a text without words is no good
        return {"score": pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30))))}

    return make


def score_quality(spark: SparkSession, docs: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """``docs`` with score (0..1, higher: good likelier).

    A null or empty text, or one of white space only, scores near 0. Repeated rows stay
    and score alike. Columns of ``docs`` named score are replaced, others stay; an empty
    table gives an empty result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(spark)
    docs = docs.drop("score").withColumn("text", F.col("text").cast("string"))
    narrow = docs.select("text")
    voted = narrow.mapInArrow(_with(0, pa.schema([("votes", pa.string())]), _votes), "votes string")
    seen = voted.groupBy("votes").count().orderBy("votes").collect()  # at most 3 ** len(LABELLERS) rows
    model = Model(np.zeros(BUCKETS), 0.0)
    if seen:
        patterns = np.array([[int(c) for c in r["votes"]] for r in seen], np.int8)
        post, _ = fit_votes(patterns, np.array([r["count"] for r in seen], float))
        posterior = {r["votes"]: p for r, p in zip(seen, post.tolist())}
        texts = _sample(docs, rows, most_bytes)
        own = ["".join(map(str, v)) for a, b in slices(pa.array(texts, pa.string())) for v in votes(figures(Words(pa.array(texts[a:b], pa.string()), BLANK))).tolist()]
        model = train(texts, np.array([posterior[v] for v in own]))
    wanted = type(docs.schema)([*docs.schema.fields, *spark.createDataFrame([], "score double").schema.fields])
    return docs.mapInArrow(_with(docs.columns.index("text"), to_arrow_schema(wanted), _scores(model)), wanted)


def _sample(docs: DataFrame, rows: int, most_bytes: int) -> list[str]:
    """At most ``rows`` different texts of ``most_bytes`` in all, by a hash of the text."""
    sized = docs.where("octet_length(text) > 0").select(F.xxhash64("text").alias("h"), F.octet_length("text").alias("size")).distinct()
    chosen, used = [], 0
    for r in sized.orderBy("h").limit(rows).collect():
        if used + r["size"] <= most_bytes:
            chosen.append((r["h"],))
            used += r["size"]
    if not chosen:
        return []
    keys = F.broadcast(small_table(docs.sparkSession, chosen, "h long"))  # at most ``rows`` rows
    first = docs.where("octet_length(text) > 0").select("text", F.xxhash64("text").alias("h")).join(keys, "h").groupBy("h").agg(F.min("text").alias("text"))
    return [r["text"] for r in first.orderBy("h").collect()]
