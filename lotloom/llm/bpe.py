"""Byte-level BPE, encoded by speculation and verification (operator 13).

Texts are cut into words as the vocabulary's file asks for, all words of a batch at once. Each
different word gets the tokens that greedy longest match proposes. A sequence of tokens
is what merging by rank yields if, and only if, merging the bytes of each two neighbours
yields these two; so one vectorised check of all different pairs of neighbours settles which
words hold. Only words with a failing pair are merged step by step.

Why pairs suffice: a merge needs its parts, which were made by merges of lower rank. So
merges on both sides of a border happen in the order of their ranks, and a merge across it
is first found between the two parts that touch it, which lie in two neighbouring tokens.

Texts are rows, and nothing is shuffled: a task holds one batch, looks at PART_BYTES of text at a
time, and keeps no words for later.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.llm.textvec import Words, gathered, raw, slices
from lotloom.session import small_batches

#: Bytes of text looked at at once.
PART_BYTES = 1 << 21
#: Words of more symbols are merged by a heap, so that none is gone through once a merge.
LONG_WORD = 48
#: Up to so many words, tokens are followed one by one.
FEW = 32

SPACE, LETTER, DIGIT, OTHER = range(4)
#: White space of Unicode.
_BLANKS = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Endings that are words of their own after an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_marks() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary's file: bytes that print stand for themselves, others follow from 256 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


def _kinds() -> np.ndarray:
    """The kind of each code point."""
    first = [unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)]
    out = np.full(len(first), OTHER, np.uint8)
    letters = np.array(first)
    out[letters == "L"], out[letters == "N"] = LETTER, DIGIT
    out[list(_BLANKS)] = SPACE
    return out


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted values would lie among sorted keys, and whether they do."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Vocabulary:
    """Tokens, merges and a prefix tree of a byte-level BPE, read from a file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("not a plain byte-level BPE")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that take their surroundings aren't supported")
        marks, tokens = _byte_marks(), model["vocab"]
        self.n = 1 + max([*tokens.values(), *(t["id"] for t in added)])
        written = [b""] * self.n
        for token, i in tokens.items():
            written[i] = bytes(marks[c] for c in token)
        self.added = {t["content"]: t["id"] for t in added}
        for content, i in self.added.items():
            written[i] = bytes(marks[c] for c in content) if all(c in marks for c in content) else content.encode()
        self.find_added = re.compile("|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.size = np.array([len(w) for w in written], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(written), np.uint8)
        self.single = np.zeros(256, np.int64)
        for mark, b in marks.items():
            self.single[b] = tokens[mark]
        self._read_merges(tokens, model["merges"])
        self._build_tree([(i, written[i]) for i in tokens.values() if self.whole[i]])
        self.kinds = _kinds()

    def _read_merges(self, tokens: dict[str, int], merges: list) -> None:
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right, made = (np.array(v, np.int64) for v in zip(*((tokens[a], tokens[b], tokens[a + b]) for a, b in pairs)))
        order = np.argsort(left * self.n + right)
        self.pairs, self.rank, self.product = (left * self.n + right)[order], order.astype(np.int64), made[order]
        #: For each token its parts and the rank at which they merge; single bytes have rank -1.
        self.left, self.right, self.made = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64), np.full(self.n, -1, np.int64)
        self.left[made], self.right[made], self.made[made] = left, right, np.arange(len(made))
        if len(np.unique(made)) != len(made) or (self.made[left] >= np.arange(len(made))).any() or (self.made[right] >= np.arange(len(made))).any():
            raise ValueError("a merge comes before those of its parts")
        # a token is only ever found if no merge crosses the border of its parts before they merge, nor one inside them
        self.whole = np.ones(self.n, bool)
        self.whole[made] = self._uncrossed(left, right)
        while (lost := made[self.whole[made] & ~(self.whole[left] & self.whole[right])]).size:
            self.whole[lost] = False

    def _build_tree(self, tokens: list[tuple[int, bytes]]) -> None:
        steps: dict[int, int] = {}
        ends: dict[int, int] = {}
        for i, data in tokens:
            node = 0
            for b in data:
                node = steps.setdefault(node << 8 | b, len(steps) + 1)
            ends[node] = i
        keys = np.fromiter(steps.keys(), np.int64, len(steps))
        order = np.argsort(keys)
        self.steps, self.child = keys[order], np.arange(1, len(keys) + 1)[order]
        self.ends = np.full(len(steps) + 1, -1, np.int64)
        self.ends[list(ends)] = list(ends.values())
        #: The node behind each two bytes, 0 if there is none.
        two = np.arange(1 << 16)
        one, there = _places(self.steps, two >> 8)
        at, deeper = _places(self.steps, self.child[one] << 8 | two & 255)
        self.second = np.where(there & deeper, self.child[at], 0)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of merging the tokens a and b; where they don't merge, a rank beyond all."""
        at, there = _places(self.pairs, a * self.n + b)
        return np.where(there, self.rank[at], len(self.pairs)), self.product[at]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of the tokens a and b gives these two, pairwise."""
        out = self.ranks(a, b)[0] == len(self.pairs)
        live = np.flatnonzero(out)
        out[live] = self._uncrossed(a[live], b[live])
        return out

    def _uncrossed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border before a and b are there.

        Time runs backwards: of the two parts at the border the one made last is undone, and a merge across
        it must not have come first. At equal ranks the left place goes first.
        """
        out, live = np.ones(len(a), bool), np.arange(len(a))
        x, y = a.copy(), b.copy()
        while True:
            more = (self.made[x] >= 0) | (self.made[y] >= 0)
            live, x, y = live[more], x[more], y[more]
            if not len(live):
                return out
            left = self.made[x] > self.made[y]
            limit = np.where(left, self.made[x], self.made[y] + 1)
            x, y = np.where(left, self.right[x], x), np.where(left, y, self.left[y])
            ok = self.ranks(x, y)[0] >= limit
            out[live[~ok]] = False
            live, x, y = live[ok], x[ok], y[ok]

    def longest(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token from each byte on that ends by its ``stop``, and its length."""
        token, size = self.single[data], np.ones(len(data), np.int64)
        live = np.flatnonzero(np.arange(1, len(data) + 1) < stop)
        node, depth = self.second[data[live].astype(np.int64) << 8 | data[live + 1]], 2
        live, node = live[node > 0], node[node > 0]
        while len(live):
            ends = self.ends[node]
            hit = live[ends >= 0]
            token[hit], size[hit] = ends[ends >= 0], depth
            more = live + depth < stop[live]
            live, node = live[more], node[more]
            at, there = _places(self.steps, node << 8 | data[live + depth])
            live, node, depth = live[there], self.child[at[there]], depth + 1
        return token, size

    def speculate(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words by greedy longest match, and where each begins; words lie in ``data`` one after another."""
        token, size = self.longest(data, np.repeat(stop, stop - start))
        reached, at, ends = np.zeros(len(data) + 1, bool), start, stop
        while len(at) > FEW:
            reached[at] = True
            at = at + size[at]
            at, ends = at[at < ends], ends[at < ends]
        if len(at):
            sizes, places = size.tolist(), []
            for i, end in zip(at.tolist(), ends.tolist()):
                while i < end:
                    places.append(i)
                    i += sizes[i]
            reached[places] = True
        places = np.flatnonzero(reached)
        return token[places], places

    def merged(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words by merging pairs of lowest rank first, and how many each word has.

        A round merges each word's best pair wherever it occurs: what that makes can only merge at higher
        ranks, so no order within the round matters, but for runs of one symbol, which pair up from the left.
        """
        size = stop - start
        word = np.repeat(np.arange(len(size)), size)
        symbol = self.single[data[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())]]
        none, done_word, done = len(self.pairs), [word[:0]], [symbol[:0]]
        while len(symbol):
            inside = word[1:] == word[:-1]
            rank, product = self.ranks(symbol[:-1], symbol[1:])
            rank = np.append(np.where(inside, rank, none), none)
            first = np.flatnonzero(np.append(True, ~inside))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            over = best == none
            done_word.append(word[over])
            done.append(symbol[over])
            chosen = np.flatnonzero((rank == best) & ~over)
            run = np.append(True, np.diff(chosen) != 1)[: len(chosen)]
            nth = np.arange(len(chosen)) - np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))
            chosen = chosen[nth % 2 == 0]
            stay = ~over
            symbol[chosen] = product[chosen]
            stay[chosen + 1] = False
            symbol, word = symbol[stay], word[stay]
        words, symbols = np.concatenate(done_word), np.concatenate(done)
        return symbols[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(size))

    def merged_long(self, data: bytes) -> list[int]:
        """Tokens of one long word, by a heap of its pairs."""
        known = dict(zip(self.pairs.tolist(), zip(self.rank.tolist(), self.product.tolist()))) if not hasattr(self, "_known") else self._known
        self._known, n = known, self.n
        symbol = self.single[np.frombuffer(data, np.uint8)].tolist()
        after, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < len(symbol) and (found := known.get(symbol[i] * n + symbol[j])):
                heapq.heappush(heap, (found[0], i, symbol[i], symbol[j]))

        for i in range(len(symbol)):
            push(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != a or j >= len(symbol) or symbol[j] != b:
                continue
            symbol[i], symbol[j] = known[a * n + b][1], -1
            after[i] = after[j]
            if after[i] < len(symbol):
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s in symbol if s >= 0]

    def encode_words(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, and how many each has: proposed, verified, and merged exactly where a pair fails."""
        token, place = self.speculate(data, start, stop)
        word = np.searchsorted(start, place, "right") - 1
        beside = np.flatnonzero(word[1:] == word[:-1])
        pair, which = np.unique(token[beside] * self.n + token[beside + 1], return_inverse=True)
        holds = self.compatible(pair // self.n, pair % self.n)
        failing = np.unique(word[beside[~holds[which]]])
        if not len(failing):
            return token, np.bincount(word, minlength=len(start))
        bad = np.zeros(len(start), bool)
        bad[failing] = True
        short = failing[stop[failing] - start[failing] <= LONG_WORD]
        got, counts = self.merged(data, start[short], stop[short])
        words, tokens = [word[~bad[word]], np.repeat(short, counts)], [token[~bad[word]], got]
        for w in np.setdiff1d(failing, short).tolist():
            tokens.append(np.array(self.merged_long(data[start[w] : stop[w]].tobytes()), np.int64))
            words.append(np.full(len(tokens[-1]), w))
        every = np.concatenate(words)
        return np.concatenate(tokens)[np.argsort(every, kind="stable")], np.bincount(every, minlength=len(start))

    def borders(self, text: str, edge: np.ndarray) -> np.ndarray:
        """Whether a word begins at each code point; ``edge`` marks where texts begin.

        A word is a run of letters, of digits or of other marks, with one space before it. Other white space
        is a word but for its last character before such a run, which is one on its own or that space.
        An apostrophe with one of some endings is a word where no space and no other mark comes before it.
        """
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.kinds[code]
        starts = edge.copy()
        starts[1:] |= kind[1:] != kind[:-1]
        blank = kind == SPACE
        inner = ~edge[1:]
        spaced = np.append(False, (code[:-1] == 32) & inner) & ~blank
        out = starts & ~spaced
        out[:-1] |= blank[:-1] & ~blank[1:] & inner
        quotes = np.flatnonzero((code == ord("'")) & out)
        padded, far = np.append(code, [0, 0, 0]), np.append(edge, [True, True, True])
        for ending in _ENDINGS:
            k = len(ending)
            hit = quotes[np.all([(padded[quotes + j + 1] == ord(c)) & ~far[quotes + j + 1] for j, c in enumerate(ending)], axis=0)]
            out[hit + 1] = False
            hit = hit[hit + k + 1 < len(out)]
            out[hit + k + 1] = True
        return out

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts whose bytes lie between offsets, and n + 1 places where each text's ids begin."""
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
        text = buf.tobytes().decode()
        point = np.flatnonzero((buf & 0xC0) != 0x80)
        edge = np.zeros(len(point), bool)
        edge[np.searchsorted(point, offs[:-1][offs[:-1] < len(buf)])] = True
        special: list[tuple[int, int, int]] = []
        if self.find_added and any(c in text for c in self.added):
            rows = np.append(np.flatnonzero(edge), len(point)).tolist()
            special = [(a + m.start(), a + m.end(), self.added[m[0]]) for a, b in zip(rows[:-1], rows[1:]) for m in self.find_added.finditer(text[a:b])]
            for a, b, _ in special:
                edge[a] = True
                edge[b : b + 1] = True
        starts = self.borders(text, edge)
        for a, b, _ in special:
            starts[a + 1 : b] = False
        words = Pieces(buf, point[starts])
        _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        # a word that shares its hash with another one stands for itself
        clash = np.flatnonzero(~words.same(np.arange(len(which)), first[which]))
        which[clash] = len(first) + np.arange(len(clash))
        chosen = np.concatenate([first, clash])
        size = words.end[chosen] - words.start[chosen]
        data, at = gathered(buf, words.start[chosen], size)
        flat, counts = self.encode_words(data, at, at + size)
        begin, per = (np.cumsum(counts) - counts)[which], counts[which]
        if special:
            places = np.searchsorted(words.start, point[[a for a, _, _ in special]])
            begin[places], per[places] = len(flat) + np.arange(len(special)), 1
            flat = np.concatenate([flat, np.array([i for _, _, i in special], np.int64)])
        total = np.zeros(len(per) + 1, np.int64)
        np.cumsum(per, out=total[1:])
        ids = flat[np.repeat(begin - total[:-1], per) + np.arange(total[-1])]
        return ids, total[np.searchsorted(words.start, offs)]


class Pieces(Words):
    """Words that follow each other without gaps, told by where they begin; every byte counts."""

    def __init__(self, buf: np.ndarray, start: np.ndarray) -> None:
        self.buf, self.start, self.end = buf, start, np.append(start[1:], len(buf))
        self.bytes = np.zeros(len(buf) + 8, np.uint8)
        self.bytes[: len(buf)] = buf
        self._eight = np.ndarray((len(buf) + 1,), "<u8", self.bytes.data, 0, (1,))
        self.hash = self._hashes()


#: By path; a worker serves many tasks.
_KEPT: dict[str, Vocabulary] = {}


def vocabulary_of(path: str) -> Vocabulary:
    if path not in _KEPT:
        _KEPT[path] = Vocabulary(path)
    return _KEPT[path]


def _parts(buf: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Stretches of one text of about ``limit`` bytes, cut before a space behind a printing ASCII character, where a word begins in any case."""
    a = 0
    while len(buf) - a > limit:
        safe, b = np.zeros(0, np.int64), a
        while not len(safe) and b < len(buf):
            b = min(b + limit, len(buf))
            part = buf[a:b]
            safe = np.flatnonzero((part[1:] == 32) & (part[:-1] > 32) & (part[:-1] < 127))
        if not len(safe):
            break
        yield a, a + 1 + int(safe[-1])
        a += 1 + int(safe[-1])
    yield a, len(buf)


def encode_column(vocabulary: Vocabulary, col: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a text column with their ids and n + 1 offsets."""
    cuts = any(" " in c for c in vocabulary.added)
    for a, b in slices(col, limit):
        buf, offs = raw(col.slice(a, b - a))
        if len(buf) > limit and b - a == 1 and not cuts:
            ids = np.concatenate([vocabulary.encode(buf[i:j], np.array([0, j - i]))[0] for i, j in _parts(buf, limit)])
            yield a, b, ids, np.array([0, len(ids)])
        else:
            yield a, b, *vocabulary.encode(buf, offs)


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in batches:
            for a, b, ids, at in encode_column(vocabulary, batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["doc_id", "ids"])

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in batches:
            lists = batch.column(1)
            texts: list[str | None] = []
            for i in range(len(lists)):
                if not lists[i].is_valid:
                    texts.append(None)
                    continue
                ids = lists[i].values.to_numpy(zero_copy_only=False)
                ids = ids[(ids >= 0) & (ids < vocabulary.n)].astype(np.int64)  # an id that isn't one has no text
                texts.append(gathered(vocabulary.bytes, vocabulary.begin[ids], vocabulary.size[ids])[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return run


def encode(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Each row's doc_id with the token ids of its whole text; ``path`` names a byte-level BPE of the tokenizers library.

    Strings of the file's added tokens in a text become these tokens. A null or empty text has no ids
    (an empty array). Repeated rows are encoded once each, further columns are ignored, an empty table gives no rows.
    """
    small_batches(spark)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_encoded(path), "doc_id long, ids array<int>")


def decode(spark: SparkSession, coded: DataFrame, path: str) -> DataFrame:
    """Rows of (doc_id, ids) with the text that the ids stand for, special tokens included.

    Bytes that are no UTF-8 are replaced by a mark, ids beyond the vocabulary are left out. No ids give an empty
    text, a null array gives null. Further columns are ignored.
    """
    small_batches(spark)
    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(_decoded(path), "doc_id long, ids array<int>, text string")


def summary(decoded: DataFrame) -> DataFrame:
    """Of (doc_id, ids, text): how many ids there are, and digests of the ids as decimals joined by commas and of the text."""
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
