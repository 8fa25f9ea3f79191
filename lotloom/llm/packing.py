"""Best-fit packing by minimum bin slack (operator 8).

Documents become token ids where they are read and are cut into pieces of at most CAPACITY
ids. Only the number of pieces of each length (at most CAPACITY figures) reaches the
driver. There bins are planned one combination at a time: the longest length left is
set, a bitset subset-sum recursion over all lengths available finds the fullest way to
complete the bin, and the combination is removed, as often as the lengths last. So a
plan has a bounded number of combinations at any input size.

Pieces then get their place without a global sort: each length's pieces are numbered in
cells of bounded size, and number ranges map to combinations.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.llm.numbering import gapless
from lotloom.llm.textvec import BLANK, Words, gathered, same_bytes, slices
from lotloom.session import Scratch, small_batches

CAPACITY = 4096
#: The id that ends each document.
END = 1
#: Words whose ids a worker keeps, words encoded as one text, bytes of text looked at at once.
CACHED_WORDS, TOGETHER, LEARN_BYTES = 500_000, 1024, 1 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: Bytes by kind: white space, letter or beyond ASCII, digit, mark, and those that ask for a closer look.
_KIND = np.full(256, 3, np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 1, 1, 1, 2
_KIND[[*range(32), 127, ord("'"), ord("<")]] = 4
_KIND[32] = 0


class _Ids:
    """Ids of the words met before: sorted hashes, the words' bytes, and where each word's ids lie in one flat array.

    A word takes some 60 bytes. When there are too many, words that repeat within the latest slice stay.
    Of words with one hash the first one met is kept.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.hash, self.begin, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")
        self.text, self.at, self.length = np.zeros(8, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def encoded(self, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words joined by single spaces, and how many each has; ``starts`` are the words' first bytes.

        The vocabulary drops white space, so words encode as they would on their own. Runs
        of letters, single digits and runs of marks are pieces, and the last token of a
        piece says that it ends; so the pieces of each word tell its tokens. Where letters
        can't be told from bytes, every token's offset tells its word, which takes longer.
        """
        text = data.decode("utf-8", "replace")
        kind = _KIND[np.frombuffer(data, np.uint8)]
        if not (kind == 4).any() and all(c.isalpha() and c.lower().isalpha() for c in set(text) if c > "\x7f"):
            got = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            piece = kind == 2
            piece[0] |= kind[0] != 0
            piece[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] != 0)
            pieces, ends = np.add.reduceat(piece, starts, dtype=np.int64), np.flatnonzero(self.ends[got]) + 1
            if pieces.sum() == len(ends):
                return got, np.diff(ends[np.cumsum(pieces) - 1], prepend=0)
        points = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
        found = self.tokenizer.encode_batch([text], add_special_tokens=False)[0]
        word = np.searchsorted(points[starts], np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0], "right") - 1
        return np.array(found.ids, "<u4"), np.bincount(word, minlength=len(starts))

    def learn(self, words: Words, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of the words at places ``fresh``, in order."""
        length = words.end[fresh] - words.start[fresh]
        text, at = gathered(words.buf, words.start[fresh], length, gap=1)
        ids, sizes, data = [], [], text.tobytes()
        for a in range(0, len(fresh), TOGETHER):
            b = min(a + TOGETHER, len(fresh))
            got, size = self.encoded(data[at[a] : at[b - 1] + length[b - 1]], at[a:b] - at[a])
            ids.append(got)
            sizes.append(size)
        return (np.concatenate(ids), np.concatenate(sizes)) if ids else (np.zeros(0, "<u4"), np.zeros(0, np.int64))

    def known(self, words: Words, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words at these places: where each would be, and whether it is there, byte by byte."""
        at = np.searchsorted(self.hash, words.hash[places])
        found = np.zeros(len(places), bool)
        if len(self.hash):
            at = np.minimum(at, len(self.hash) - 1)
            hit = np.flatnonzero(self.hash[at] == words.hash[places])
            w, own = places[hit], at[hit]
            found[hit] = same_bytes(words.bytes, words.start[w], words.end[w] - words.start[w], self.text, self.at[own], self.length[own])
        return at, found

    def keep(self, words: Words, places: np.ndarray, begin: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        """Add the words at these places, ordered by hash, whose ids begin in ``flat`` as told."""
        if len(self.hash) + len(places) > CACHED_WORDS:
            self.hash, self.begin, self.size, self.flat = self.hash[:0], self.begin[:0], self.size[:0], self.flat[:0]
            self.text, self.at, self.length = np.zeros(8, np.uint8), self.at[:0], self.length[:0]
        hashes, length = words.hash[places], words.end[places] - words.start[places]
        place = np.searchsorted(self.hash, hashes)
        if len(self.hash):
            free = self.hash[np.minimum(place, len(self.hash) - 1)] != hashes
            places, begin, size, hashes, length, place = (v[free] for v in (places, begin, size, hashes, length, place))
        text, text_at = gathered(words.buf, words.start[places], length)
        at = np.cumsum(size) - size
        own = flat[np.repeat(begin - at, size) + np.arange(size.sum())]
        insert = lambda old, new: np.insert(old, place, new)
        self.hash, self.size, self.length = insert(self.hash, hashes), insert(self.size, size), insert(self.length, length)
        self.begin, self.at = insert(self.begin, at + len(self.flat)), insert(self.at, text_at + len(self.text) - 8)
        self.flat, self.text = np.concatenate([self.flat, own]), np.concatenate([self.text[:-8], text, np.zeros(8, np.uint8)])


#: By path; a worker serves many tasks.
_KEPT: dict[str, _Ids] = {}


def ids_of(path: str) -> _Ids:
    from tokenizers import Tokenizer

    if path not in _KEPT:
        _KEPT[path] = _Ids(Tokenizer.from_file(path))
    return _KEPT[path]


def tokens(ids: _Ids, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts of a column and where each text's begin (n + 1 places). Each different word is encoded once."""
    words = Words(col, BLANK, exact=True)
    if not len(words.hash):
        return np.zeros(0, "<u4"), np.zeros(len(col) + 1, np.int64)
    uniq, first, which, count = np.unique(words.hash, return_index=True, return_inverse=True, return_counts=True)
    place, known = ids.known(words, first)
    begin, size = np.zeros(len(uniq), np.int64), np.zeros(len(uniq), np.int64)
    begin[known], size[known] = ids.begin[place[known]], ids.size[place[known]]
    fresh = ~known
    # words that ask for a closer look come last, so that they don't slow down the others
    odd = np.add.reduceat(np.append(_KIND[words.buf] == 4, False), np.stack([words.start, words.end], 1).ravel())[::2]
    order = np.flatnonzero(fresh)
    order = order[np.argsort(odd[first[order]] > 0, kind="stable")]
    # words that share a hash with another one are encoded one by one
    clash = np.flatnonzero(~words.same(np.arange(len(which)), first[which]))
    got, sizes = ids.learn(words, np.concatenate([first[order], clash]))
    new_begin = len(ids.flat) + np.cumsum(sizes) - sizes
    begin[order], size[order] = new_begin[: len(order)], sizes[: len(order)]
    flat = np.concatenate([ids.flat, got])
    stay = fresh & (count > 1) if len(ids.hash) + fresh.sum() > CACHED_WORDS else fresh
    ids.keep(words, first[stay], begin[stay], size[stay], flat)
    per, begins = size[which], begin[which]
    per[clash], begins[clash] = sizes[len(order) :], new_begin[len(order) :]
    at = np.zeros(len(per) + 1, np.int64)
    np.cumsum(per, out=at[1:])
    return flat[np.repeat(begins - at[:-1], per) + np.arange(at[-1])], at[words.first]


def _cut(path: str, capacity: int):
    last = END.to_bytes(4, "little")
    names = [f.split()[0] for f in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(path)
        for batch in batches:
            for a, b in slices(batch.column(1), LEARN_BYTES):
                flat, at = tokens(ids, batch.column(1).slice(a, b - a))
                size = np.diff(at) + 1
                pieces = -(-size // capacity)
                doc = np.repeat(np.arange(b - a), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, size[doc] - start)
                low, ends = at[doc] + start, piece == pieces[doc] - 1
                crc = [zlib.crc32(last, c) if e else c for c, e in zip((zlib.crc32(flat[i:j]) for i, j in zip(low.tolist(), (low + length - ends).tolist())), ends.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=names)

    return run


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room`` (longer lengths first)."""
    lengths = sorted((n for n in counts if n <= room and counts[n]), reverse=True)
    reach, steps, full = 1, [], (1 << (room + 1)) - 1
    for n in lengths:
        left, size = min(counts[n], room // n), 1
        while left > 0:  # a length's copies in powers of two, so each count can be reached
            take = min(size, left)
            steps.append((n, take, reach))
            reach |= (reach << (n * take)) & full
            left, size = left - take, size * 2
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for n, take, before in reversed(steps):
        if not before >> at & 1:
            at -= n * take
            out[n] = out.get(n, 0) + take
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how often, {length: copies in a bin}) for all pieces, fullest bins found first."""
    left, out = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        top = max(left)
        bin_ = {top: 1}
        rest = dict(left)
        rest[top] -= 1
        for n, k in fullest(rest, capacity - top).items():
            bin_[n] = bin_.get(n, 0) + k
        times = min(left[n] // k for n, k in bin_.items())
        out.append((times, bin_))
        for n, k in bin_.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def places(bins: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[list[int], list[tuple[int, int, int]]]]:
    """For each length: where number ranges begin, and (copies in a bin, first sequence, offset) of each range."""
    out: dict[int, tuple[list[int], list[tuple[int, int, int]]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, bin_ in bins:
        offset = 0
        for n in sorted(bin_, reverse=True):
            lows, facts = out.setdefault(n, ([], []))
            lows.append(used.get(n, 0))
            facts.append((bin_[n], sequence, offset))
            used[n] = used.get(n, 0) + times * bin_[n]
            offset += n * bin_[n]
        sequence += times
    return out


def _placed(where: dict[int, tuple[list[int], list[tuple[int, int, int]]]], schema: pa.Schema):
    span = 1 << 48  # above any number of pieces
    key = np.array([n * span + low for n in sorted(where) for low in where[n][0]], np.int64)
    facts = np.array([f for n in sorted(where) for f in where[n][1]], np.int64).reshape(-1, 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(key, length * span + number, "right") - 1
            copies, first, offset = facts[at].T
            k, j = np.divmod(number - key[at] % span, copies)
            new = {"sequence_id": pa.array(first + k), "offset": pa.array(offset + j * length)}
            yield pa.RecordBatch.from_arrays([new.get(f.name) if f.name in new else batch.column(f.name) for f in schema], schema=schema)

    return run


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizers file on the executors whose pre-tokenizer
    drops white space. Each document is its ids and the id END; a null or empty text is
    END alone. Longer documents are cut into pieces of ``capacity``, the last may be
    shorter. Repeated rows are packed once each; a null doc_id stays null. Further columns
    are ignored; an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(spark)
    scratch = Scratch(spark, "packing")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = scratch.write(narrow.mapInArrow(_cut(tokenizer, capacity), PIECES), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    where = places(plan(counts, capacity))
    numbered = gapless(pieces, "length", counts, ["doc_id", "piece", "ids_crc32"], "number")
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number")
    wanted = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    schema = to_arrow_schema(spark.createDataFrame([], wanted).schema)
    return numbered.mapInArrow(_placed(where, schema), wanted)
