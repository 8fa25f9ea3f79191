"""Repair of conversations by Viterbi with survivor coalescence (operator 11).

Rows of a conversation are kept, given another role or deleted, and empty turns are put between
them, so that roles read: perhaps a system turn, then user and assistant in turns. Of the
cheapest ways the one with the ASCII-least string of edits counts.

States say what was put out last. Each state has one survivor, a leaf of a tree of back pointers whose nodes count
what refers to them: a node that no survivor needs goes, and when the root has a single
successor, all survivors share it: its edits are settled, leave the tree and the row leaves memory. Ties are
decided by the whole strings that aren't settled, from the root on. A survivor that can't win any more,
because another one reaches all it can at a lower cost, is dropped, so that survivors meet soon.

Insertions come right before a row that stays, so two strings of one row end in that row's edit; neither is
a beginning of the other, and the lesser one stays so whatever follows.

Faults are found by Spark: a repeat is told by the first turn of each role and text, an aggregate. Rows
are then dealt by conversation, sorted, and stream through Python a batch at a time.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.llm.joins import attach, unused
from lotloom.session import Scratch, small_batches

#: What was put out last: nothing, a system turn, a user's, an assistant's.
START, HEAD, ASKED, ANSWERED = range(4)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: How many turns must be put in before a turn of the initial may follow, by state.
_BEFORE = {"s": {START: 0}, "u": {START: 0, HEAD: 0, ASKED: 1, ANSWERED: 0}, "a": {START: 1, HEAD: 1, ASKED: 0, ANSWERED: 1}}
_AFTER = {"s": HEAD, "u": ASKED, "a": ANSWERED}
#: What must still be put in at the end, by state.
_CLOSING = {START: 0, HEAD: 2, ASKED: 1, ANSWERED: 0}
#: A state is out of the race if another one is cheaper by more than this: what it takes to do the same from there.
_BRIDGES = {START: {ANSWERED: DELETE, ASKED: INSERT + DELETE}, HEAD: {START: 0, ANSWERED: 0, ASKED: INSERT}, ASKED: {ANSWERED: INSERT}, ANSWERED: {ASKED: INSERT}}
SPACES = r"\x20\x09-\x0D"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)


class _Node:
    """The edits of one row on a way; ``kids`` and ``held`` (it is a survivor) are what refers to it."""

    __slots__ = ("parent", "edits", "kids", "held")

    def __init__(self, parent: _Node | None, edits: str) -> None:
        self.parent, self.edits, self.kids, self.held = parent, edits, set(), False
        if parent is not None:
            parent.kids.add(self)


class Survivors:
    """The cheapest ways to each state, and the edits that all of them share."""

    def __init__(self) -> None:
        self.root = _Node(None, "")
        self.root.held = True
        self.ways: dict[int, tuple[int, _Node]] = {START: (0, self.root)}

    def _open(self, node: _Node) -> str:
        """The edits of a way that aren't settled yet."""
        parts = []
        while node is not self.root:
            parts.append(node.edits)
            node = node.parent  # type: ignore[assignment]
        return "".join(reversed(parts))

    def _options(self, initial: str, lost: bool, extra: int) -> Iterator[tuple[int, int, _Node, str]]:
        for state, (cost, node) in self.ways.items():
            yield state, cost + DELETE, node, "D"
            if lost:
                continue
            for said in ("s", "u", "a"):
                edit, price = ("K", KEEP) if said == initial else ("R", REROLE)
                if state in _BEFORE[said] and (said != "s" or edit == "K"):
                    n = _BEFORE[said][state]
                    yield _AFTER[said], cost + n * INSERT + price + extra, node, "I" * n + edit

    def step(self, initial: str, lost: bool, extra: int) -> list[str]:
        """Take in a row by its role's initial, whether it must be deleted, and what it costs to leave it. Edits of rows that are settled now."""
        best: dict[int, tuple[int, _Node, str]] = {}
        for state, cost, node, edits in self._options(initial, lost, extra):
            old = best.get(state)
            if old is None or cost < old[0] or cost == old[0] and self._open(node) + edits < self._open(old[1]) + old[2]:
                best[state] = cost, node, edits
        best = {s: b for s, b in best.items() if not any(o in best and b[0] > best[o][0] + gap for o, gap in _BRIDGES[s].items())}
        old_nodes = [node for _, node in self.ways.values()]
        self.ways = {}
        for state, (cost, node, edits) in best.items():
            leaf = _Node(node, edits)
            leaf.held = True
            self.ways[state] = cost, leaf
        for node in old_nodes:
            node.held = False
            while node is not self.root and not node.kids and not node.held:
                node.parent.kids.discard(node)  # type: ignore[union-attr]
                node = node.parent  # type: ignore[assignment]
        return self._settled()

    def _settled(self) -> list[str]:
        out = []
        while not self.root.held and len(self.root.kids) == 1:
            (self.root,) = self.root.kids
            self.root.parent = None
            out.append(self.root.edits)
        return out

    def finish(self) -> tuple[int, list[str], str]:
        """The cost of the best way, the edits of its rows that weren't settled, and what is put in at the end."""
        ends = [(cost + _CLOSING[s] * INSERT, self._open(node) + "I" * _CLOSING[s], s, node) for s, (cost, node) in self.ways.items()]
        cost, _, state, node = min(ends, key=lambda e: e[:2])
        parts = []
        while node is not self.root:
            parts.append(node.edits)
            node = node.parent
        return cost, parts[::-1], "I" * _CLOSING[state]


class _Conversation:
    """One conversation as its rows come in: counts, and turns as soon as their edits are settled."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.survivors = conv_id, Survivors()
        self.waiting: deque[tuple[int | None, str, str]] = deque()
        self.low = self.high = None
        self.turns, self.counts, self.illegal, self.last, self.initial = 0, [0, 0, 0, 0], 0, None, None
        self.state, self.place, self.sha, self.said = START, 0, hashlib.sha256(), False
        self.audit: list[str] = []

    def add(self, turn: int | None, role: str, text: str, fault: int) -> Iterator[tuple]:
        if fault != BLANK and (turn, role, text) == self.last:
            fault = DUPLICATE
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.last, self.initial = (turn, role, text), initial
        self.counts[fault] += 1
        self.waiting.append(self.last)
        settled = self.survivors.step(initial, fault in (BLANK, DUPLICATE), CUT if fault == TRUNCATED else 0)
        return self._put_out(settled)

    def _put_out(self, settled: list[str]) -> Iterator[tuple]:
        """Turns and deleted rows: conv_id, place, edit, turn, role, text."""
        for edits in settled:
            row = self.waiting.popleft()
            for edit in edits:
                yield self._turn(edit, *(row if edit != "I" else (None, "", "")))

    def _turn(self, edit: str, turn: int | None, role: str, text: str) -> tuple:
        if edit in "RI":
            role = "assistant" if self.state == ASKED else "user"
        if edit != "D":
            self.state = _AFTER[role[0]]
            self.sha.update(f"{chr(10) if self.said else ''}{role}:{text}".encode("utf-8", "replace"))
            self.said = True
        self.audit.append(edit)
        self.place += 1
        return self.conv_id, self.place - 1, edit, turn, role, text

    def finish(self) -> Iterator[tuple]:
        self.cost, settled, tail = self.survivors.finish()
        yield from self._put_out(settled)
        for edit in tail:
            yield self._turn(edit, None, "", "")

    def figures(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, *self.counts[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


TURNS = "conv_id long, place long, edit string, turn long, role string, text string"
FIGURES = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _stream(schema: pa.Schema, turns: bool, held_bytes: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        rows: list[tuple] = []
        held = 0

        def take(found: Iterator[tuple]) -> None:
            nonlocal held
            for turn in found:
                if turns:
                    rows.append(turn)
                    held += len(turn[5]) + 64

        def ready() -> pa.RecordBatch:
            nonlocal rows, held
            columns = list(zip(*rows)) if rows else [()] * len(schema)
            rows, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        def close() -> None:
            nonlocal held
            if now is not None:
                take(now.finish())
                if not turns:
                    rows.append(now.figures())
                    held += len(rows[-1][7]) + 200

        for batch in batches:
            for conv, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now.conv_id:
                    close()
                    now = _Conversation(conv)
                take(now.add(turn, role, text, fault))
                if held > held_bytes:
                    yield ready()
        close()
        if rows:
            yield ready()

    return run


def faulted(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``fault``: blank, a repeat of an earlier turn, truncated, or none of these.

    A repeat within the same turn isn't told here but by the row before it in the order of turn, role and text.
    """
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    own, turn_key, first = unused(rows.columns, "own", "turn_key", "first")
    # role and text as one key; lengths keep them apart, and nulls of conv_id are a value like others
    key = F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.length("role"), F.col("role"), F.col("text")).cast("binary"), 256)
    keyed = rows.withColumns({own: key, turn_key: F.struct(F.col("turn").isNotNull().cast("int").alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))})
    firsts = Scratch(spark, "repair").write(keyed.groupBy(own).agg(F.min(turn_key).alias(first)), "firsts")
    met = attach(keyed, firsts, [own], ["turn"], "left", 128)
    said = F.col("text").rlike(f"[^{SPACES}]")
    fault = F.when(~said, BLANK).when(F.col(turn_key) > F.col(first), DUPLICATE).when(~F.col("text").rlike(rf"[.!?][{SPACES}]*\z"), TRUNCATED).otherwise(NONE)
    return met.select("conv_id", "turn", "role", "text", fault.alias("fault"))


def _repaired(spark: SparkSession, rows: DataFrame, turns: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(spark)
    dealt = faulted(spark, rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    names = TURNS if turns else FIGURES
    return dealt.mapInArrow(_stream(to_arrow_schema(spark.createDataFrame([], names).schema), turns), names)


def repaired_turns(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The turns of the repaired conversations, in ``place`` order: conv_id, place, edit, turn, role, text.

    ``edit`` is K (kept), R (role changed), I (put in, with a null turn) or D: such rows are what was deleted
    and have to be left out of the conversation. Rows of a conversation are taken by turn (null first), equal
    turns by role and text. A null role or text is one space; rows with a null conv_id are one
    conversation. Blank texts and repeats are always deleted. Further columns are ignored, an empty table gives no rows.
    """
    return _repaired(spark, rows, True)


def repair_figures(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Of the same repair one row per conversation: faults before it, its cost, the edits as a string, and a digest of its turns."""
    return _repaired(spark, rows, False)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by a checksum of conv_id and turn (nulls: one space): dropped, emptied, without marks, repeated, or said by a user."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(text_of("role"))
    twice = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_")
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), twice).drop("_")
