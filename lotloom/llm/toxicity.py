"""Toxic spans by a linear-chain conditional random field (operator 3).

Training runs on the driver over a bounded sample of labelled documents (SAMPLE_ROWS rows,
SAMPLE_BYTES of text of each class). A document's label says what its tokens can be: in a
clean one every token has state 0, in a toxic one at least one has state 1. A two-state
chain over hashed words, their beginnings and neighbours is fitted to that by maximum
likelihood. With the weight of the path of zeros set to 1, both cases need nothing but
the chain's total weight Z, for P(no toxic token) = 1 / Z. Texts that share their least
five-word gram count once together, so that copies don't make the words of one toxic text look toxic.

The score of a document is 1 - 1 / Z, so a token whose marginal passes one half always
takes its document past one half. Marginals of at least one half are the spans.

Both recursions are chains of Moebius maps on the odds of the toxic state. They run
exactly and vectorised: products within chunks, one step per chunk, then all chunks
side by side. Documents are scored where they are read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.llm.textvec import ALNUM, Words, mix, slices
from lotloom.session import Scratch, small_batches, small_table

#: Bounds of the labelled sample that is brought to the driver, for each of the two labels.
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 2 << 20
#: Hashed features of each place; the places: the word, its beginnings of these lengths in bytes, the words before and after.
BUCKETS, HEADS = 1 << 17, (4, 5, 6, 7, 8)
PLACES = 3 + len(HEADS)
_NONE = BUCKETS  # no word there, or a word too short for such a beginning
#: Bytes of text that training looks at together.
PART_BYTES = 1 << 19
#: Steps of the fit and the penalties of a word's weight and of a neighbour's (chosen by folds of training rows).
ROUNDS, PENALTY, NEIGHBOUR = 60, 0.05, 1.0
#: Penalty of the weights of leaving and of keeping the toxic state.
SETTLED = 10.0
#: A feature has a weight of its own if so many toxic texts that aren't copies hold it.
LEAST_TEXTS = 2
SPANS = "array<struct<first:int,last:int>>"


@dataclass
class Model:
    weights: np.ndarray  # PLACES x (BUCKETS + 1)
    bias: float
    start: float  # log odds of the toxic state at a text's start
    trans: np.ndarray  # log weights from state i to state j
    prior: float | None = None  # the score of every text, where nothing could be learnt


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids (PLACES x tokens) and which tokens are a text's first."""
    n = len(words.hash)
    out = np.full((PLACES, n), _NONE, np.int32)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    full = np.flatnonzero(words.count)
    first[words.first[full]] = True
    last[words.first[full + 1] - 1] = True
    out[0] = words.hash % np.uint64(BUCKETS)
    for place, k in enumerate(HEADS, 1):
        at = np.flatnonzero(words.end - words.start >= k)
        out[place, at] = mix(words.head(k, at)) % np.uint64(BUCKETS)
    out[-2, 1:], out[-1, :-1] = out[0, :-1], out[0, 1:]
    out[-2, first], out[-1, last] = _NONE, _NONE
    return out, first


def _scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x[t] = (a[t] x[t-1] + b[t]) / (c[t] x[t-1] + d[t]) for all t, with x[-1] = 1."""
    n = len(a)
    side = max(1, int(n**0.5))
    cols = -(-n // side)  # chunks of ``side`` steps
    pad = side * cols - n
    shape = lambda v, fill: np.ascontiguousarray(np.concatenate([v, np.full(pad, fill)]).reshape(cols, side).T)
    a, b, c, d = shape(a, 1.0), shape(b, 0.0), shape(c, 0.0), shape(d, 1.0)
    p, q, r, s = a[0].copy(), b[0].copy(), c[0].copy(), d[0].copy()
    for t in range(1, side):
        p, q, r, s = a[t] * p + b[t] * r, a[t] * q + b[t] * s, c[t] * p + d[t] * r, c[t] * q + d[t] * s
        k = 1 / (p + q + r + s)
        p, q, r, s = p * k, q * k, r * k, s * k
    x, entry = 1.0, np.empty(cols)
    for i, (pi, qi, ri, si) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        entry[i] = x
        x = (pi * x + qi) / (ri * x + si)
    out, now = np.empty((side, cols)), entry
    for t in range(side):
        now = (a[t] * now + b[t]) / (c[t] * now + d[t])
        out[t] = now
    return out.T.ravel()[:n]


def marginals(score: np.ndarray, first: np.ndarray, start: float, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Toxic-state marginal of each token, and the forward and backward odds."""
    e = np.exp(np.clip(score, -30, 30))
    w = np.exp(trans)
    fwd = _scan(np.where(first, 0, w[1, 1] * e), np.where(first, np.exp(start) * e, w[0, 1] * e), np.where(first, 0, w[1, 0]), np.where(first, 1, w[0, 0]))
    # what the token at t passes back to the one before; at a text's start nothing passes
    back = _scan(*(v[::-1] for v in (np.where(first, 0, w[1, 1] * e), np.where(first, 1, w[1, 0]), np.where(first, 0, w[0, 1] * e), np.where(first, 1, w[0, 0]))))[::-1]
    beta = np.ones(len(e))
    beta[:-1] = back[1:]
    odds = fwd * beta
    return odds / (1 + odds), fwd, beta


def log_weights(fwd: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """What each token adds to the logarithm of the weight of its text's path of zeros and of its total Z: two rows."""
    before = np.zeros(len(fwd))
    before[1:] = np.where(first[1:], 0, fwd[:-1])
    return np.stack([np.log1p(before * np.exp(trans[1, 0])), np.log1p(fwd)])


def log_totals(words, fwd: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """log Z of each text; 0 for one without words."""
    out = np.zeros(len(words.count))
    full = np.flatnonzero(words.count)
    if len(full):
        steps, ends = log_weights(fwd, first, trans)
        out[full] = np.add.reduceat(steps, words.first[full]) + ends[words.first[full + 1] - 1]
    return out


class _Part:
    """Some texts of the sample: features of their tokens, and which texts are kin."""

    def __init__(self, col: pa.Array, offset: int) -> None:
        w = Words(col, ALNUM)
        self.ids, self.begin = features(w)
        self.count, self.first, self.row = w.count, w.first, w.row
        self.texts = slice(offset, offset + len(col))
        self.kin = mix(np.arange(offset, offset + len(col), dtype=np.uint64))  # texts of fewer than five words are kin to none
        whole = w.whole(5)
        if len(whole):
            rows, at = np.unique(w.row[whole], return_index=True)
            self.kin[rows] = np.minimum.reduceat(w.grams(5)[whole], at)

    def number(self, numbers: np.ndarray) -> None:
        """Replace features by (token, number) of those that have a weight."""
        token, entry = [], []
        for place in range(PLACES):
            found = numbers[place][self.ids[place]]
            token.append(np.flatnonzero(found >= 0).astype(np.int32))
            entry.append(found[token[-1]])
        self.token, self.entry = np.concatenate(token), np.concatenate(entry)
        del self.ids


def _slope(part: _Part, theta: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Gradient of the weighted loss over the texts of a part."""
    bias, start, t01, t10, t11 = theta[-5:]
    trans = np.array([[0.0, t01], [t10, t11]])
    score = np.bincount(part.token, theta[part.entry], len(part.row)) + bias
    p, fwd, beta = marginals(score, part.begin, start, trans)
    z = log_totals(part, fwd, part.begin, trans)
    # the slope of the loss in log Z: 1 for a clean text, -1 / (Z - 1) for a toxic one
    slope = weight * np.where(toxic, -1 / np.maximum(np.expm1(np.minimum(z, 500)), 1e-12), 1.0)
    slope[part.count == 0] = 0
    pull = slope[part.row] * p
    grad = np.zeros_like(theta)
    grad[:-5] = np.bincount(part.entry, pull[part.token], len(theta) - 5)
    grad[-5], grad[-4] = pull.sum(), pull[part.begin].sum()
    # pair marginals from the odds at both sides
    follows = np.flatnonzero(~part.begin)
    e, r, b = np.exp(np.clip(score[follows], -30, 30)), fwd[follows - 1], beta[follows]
    cell = (np.exp(t01) * e * b, r * np.exp(t10), r * np.exp(t11) * e * b)
    by = slope[part.row[follows]] / (1 + sum(cell))
    grad[-3:] = [(by * c).sum() for c in cell]
    return grad


def train(texts: list[str], labels: list[int], shares: tuple[float, float] = (1.0, 1.0), penalty: float = PENALTY, neighbour: float = NEIGHBOUR, rounds: int = ROUNDS) -> Model:
    """Fit the chain. ``shares``: how much a clean and a toxic text count. One class only, or no words: the prior is the score.

    Texts are looked at in parts of PART_BYTES, so only their features are held at once.
    """
    toxic = np.array(labels, bool)
    prior = float(np.clip(np.average(toxic, weights=np.where(toxic, shares[1], shares[0])), 1e-4, 1 - 1e-4)) if len(toxic) else 1e-4
    model = Model(np.zeros((PLACES, BUCKETS + 1), np.float32), -4.0, -4.0, np.array([[0.0, -4.0], [0.0, 0.0]]))
    col = pa.array(texts, pa.string())
    parts = [_Part(col.slice(a, b - a), a) for a, b in slices(col, PART_BYTES)]
    kins, kin = np.unique(np.concatenate([p.kin for p in parts]) if parts else np.zeros(0, np.uint64), return_inverse=True)
    # features that several toxic texts hold, copies counted once
    held = [np.zeros(0, np.int64)]
    for place in range(PLACES):
        pairs = []
        for p in parts:
            at = np.flatnonzero(toxic[p.texts][p.row])
            pairs.append(np.unique(p.ids[place, at].astype(np.int64) * len(kins) + kin[p.texts][p.row[at]]))
        one, n = np.unique(np.unique(np.concatenate(pairs)) // len(kins), return_counts=True) if len(kins) else (np.zeros(0, np.int64), np.zeros(0))
        held.append(one[(n >= LEAST_TEXTS) & (one != _NONE)] + place * (BUCKETS + 1))
    held = np.concatenate(held)
    if not len(held) or toxic.all():
        model.prior = prior
        return model
    numbers = np.full((PLACES, BUCKETS + 1), -1, np.int32)
    numbers.ravel()[held] = np.arange(len(held))
    for p in parts:
        p.number(numbers)
    near = held // (BUCKETS + 1) >= PLACES - 2
    weight = np.where(toxic, shares[1], shares[0]) / np.bincount(kin * 2 + toxic)[kin * 2 + toxic]
    weight /= weight.mean()
    theta = np.concatenate([np.zeros(len(held)), [model.bias, model.start, *model.trans[(0, 1, 1), (1, 0, 1)]]])
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    l2 = np.concatenate([np.where(near, neighbour, penalty), [0, 0, 0, SETTLED, SETTLED]])
    rate = np.concatenate([np.where(near, 0.1, 0.4), np.full(5, 0.15)])
    for step in range(1, rounds + 1):
        grad = l2 * theta
        for p in parts:
            grad += _slope(p, theta, toxic[p.texts], weight[p.texts])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        theta -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        theta[-5:] = np.clip(theta[-5:], -12, 12)
    model.weights.ravel()[held] = theta[:-5]
    model.bias, model.start = float(theta[-5]), float(theta[-4])
    model.trans = np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]])
    return model


def judged(model: Model, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The score of each text and the toxic-state marginal of each token."""
    if model.prior is not None or not len(words.hash):
        return np.full(len(words.count), model.prior or 0.0), np.zeros(len(words.hash))
    ids, first = features(words)
    score = np.full(len(first), model.bias)
    for place in range(PLACES):
        score += model.weights[place][ids[place]]
    p, fwd, _ = marginals(score, first, model.start, model.trans)
    return -np.expm1(-log_totals(words, fwd, first, model.trans)), p


def _spans(words: Words, row: int, marked: np.ndarray) -> list[dict[str, int]]:
    """Runs of marked tokens of a text as code points [first, last)."""
    own = marked[words.first[row] : words.first[row + 1]]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], own.astype(np.int8), [0]))))
    at, text = words.offs[row], words.buf[words.offs[row] : words.offs[row + 1]]
    points = np.zeros(len(text) + 1, np.int64)
    np.cumsum((text & 0xC0) != 0x80, out=points[1:])
    s, e = words.start[words.first[row] + edge[::2]] - at, words.end[words.first[row] + edge[1::2] - 1] - at
    return [{"first": int(a), "last": int(b)} for a, b in zip(points[s], points[e])]


def _scored(model: Model, text_at: int, schema: pa.Schema, names: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(text_at)):
                part = batch.slice(a, b - a)
                words = Words(part.column(text_at), ALNUM)
                spans: list[list] = [[] for _ in range(b - a)]
                score, p = judged(model, words)
                marked = p >= 0.5
                for row in np.unique(words.row[marked]).tolist():
                    spans[row] = _spans(words, row, marked)
                new = [pa.array(score), pa.array(spans, schema.field(names[1]).type)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], schema=schema)

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> tuple[list[tuple[str, int]], tuple[float, float]]:
    """A bounded sample (text, label) of the labelled rows that are not held out, and how many rows one of each label stands for.

    Of each label, rows are taken in the order of a hash of their id, up to ``rows`` and
    ``most_bytes`` of text; a row that doesn't fit is passed over. Ids and sizes are looked
    at first, so only chosen texts reach the driver. Ids that are labelled twice count by the larger label.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sized = docs.where(F.col("text").isNotNull()).select("doc_id", F.octet_length("text").alias("size"))
    scratch = Scratch(spark, "sample")
    sized = scratch.write(sized.join(known, "doc_id").select("doc_id", "size", "label", F.xxhash64("doc_id").alias("h")), "sized")
    there = {r["label"]: r["n"] for r in sized.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen, shares = [], [1.0, 1.0]
    for value in (0, 1):
        used, before = 0, len(chosen)
        for r in sized.where(F.col("label") == value).orderBy("h", "doc_id").limit(rows).collect():
            if used + r["size"] <= most_bytes:
                chosen.append((r["doc_id"], value))
                used += r["size"]
        if len(chosen) > before:
            shares[value] = there[value] / (len(chosen) - before)
    scratch.drop("sized")
    if not chosen:
        return [], (1.0, 1.0)
    ids = small_table(spark, sorted(set(chosen)), "doc_id long, label int")  # at most 2 * ``rows`` rows
    got = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label").collect()
    return [(t, y) for _, t, y in sorted({(r["doc_id"], r["text"], r["label"]) for r in got})], (shares[0], shares[1])


def score_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, score: str = "score", spans: str = "spans") -> DataFrame:
    """``docs`` with the columns ``score`` (0..1, higher: toxic likelier) and ``spans`` (toxic runs in code points).

    Learns from ``labels`` (doc_id, toxic) of rows that are not held out; nothing but the
    text enters a score. A null text counts as empty; a text without words scores 0.
    Without usable labels every score is the prior. Repeated rows stay and score alike. All
    columns of ``docs`` stay but those that bear the two new names, which are replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(spark)
    docs = docs.drop(score, spans).withColumn("text", F.col("text").cast("string"))
    got, shares = sample(spark, docs, labels, "toxic")
    model = train([t for t, _ in got], [y for _, y in got], shares)
    del got
    schema = type(docs.schema)([*docs.schema.fields, *spark.createDataFrame([], f"`{score}` double, `{spans}` {SPANS}").schema.fields])
    return docs.mapInArrow(_scored(model, docs.columns.index("text"), to_arrow_schema(schema), (score, spans)), schema)
