"""Chat formatting by incremental black-box rendering (operator 7).

A template is any function from a list of (role, text) to a string. To find where each
turn lies, the turns are rendered as growing prefixes and consecutive outputs are
compared: what a longer prefix adds is the span of its last turn, and an output that
doesn't begin with the one before it shows that the template rewrites its history.

Every prefix is rendered, whatever the length: a template may rewrite its history at any turn, and only the
prefix that ends there shows it. The first one that doesn't go on from the output before it ends the
search. So a conversation of n turns costs n renderings of half of them on average, as the method has it.

Conversations are gathered by a sort within hash partitions and stream through Python
one at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.session import small_batches

Turn = tuple[str, str]

#: Control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROLS)))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
#: A turn as the template writes it: its role's mark, the escaped text, the end mark.
_TURN = re.compile(r"<s>(?:(\[INST\])|(<<SYS>>)|(\[ROLE\](?P<role>(?:[^\\\[]|\\.|\[(?!/ROLE\]))*)\[/ROLE\]))?(?P<text>(?:[^\\<]+|\\.|<(?!/s>))*)</s>", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before each backslash and each control string."""
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def template(turns: list[Turn]) -> str:
    """``<s>`` mark text ``</s>`` for each turn. Assistants bear no mark, users [INST], systems <<SYS>>, others their name."""
    marks = {"assistant": "", "user": "[INST]", "system": "<<SYS>>"}
    return "".join(f"<s>{marks[r] if r in marks else f'[ROLE]{escape(r)}[/ROLE]'}{escape(t)}</s>" for r, t in turns)


def locate(render: Callable[[list[Turn]], str], turns: list[Turn]) -> tuple[str, list[tuple[int, int]], bool]:
    """The output, each turn's span in it, and whether the template rewrites history.

    If it does, spans can't be told from outputs alone and come back empty.
    """
    before = render([])
    ends = [len(before)]
    for i in range(1, len(turns) + 1):
        out = render(turns[:i])
        if not out.startswith(before):
            return render(turns), [], True
        ends.append(len(out))
        before = out
    return before, list(zip(ends[:-1], ends[1:])), False


def parse(span: str) -> Turn | None:
    """Role and text of one rendered turn; nothing if it isn't one."""
    m = _TURN.fullmatch(span)
    if not m:
        return None
    role = "user" if m[1] else "system" if m[2] else unescape(m["role"]) if m[3] else "assistant"
    return role, unescape(m["text"])


FORMATTED = "conv_id long, formatted string, spans array<struct<first:long,last:long,loss:boolean>>, rewritten boolean, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def format_one(conv_id: int | None, turns: list[Turn], render: Callable[[list[Turn]], str] = template) -> dict:
    """The output of a conversation, its spans, and what reading the output back gives."""
    out, spans, rewritten = locate(render, turns)
    whole, loss, marked, n_loss = hashlib.sha256(), hashlib.sha256(), [], 0
    read = [parse(out[a:b]) for a, b in spans]
    for (a, b), turn in zip(spans, read):
        role, text = turn or ("", "")
        whole.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
        marked.append({"first": a, "last": b, "loss": role == "assistant"})
        if role == "assistant":
            n_loss += len(text)
            loss.update(text.encode("utf-8", "replace"))
    return {
        "conv_id": conv_id, "formatted": out, "spans": marked, "rewritten": rewritten, "n_turns": sum(t is not None for t in read), "turns_sha256": whole.hexdigest(),
        "loss_chars": n_loss, "loss_sha256": loss.hexdigest(), "formatted_chars": len(out),
    }


def _stream(schema: pa.Schema, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = run
        turns: list[Turn] = []
        rows: list[dict] = []
        held = 0

        def close() -> None:
            nonlocal held
            if now is not run:
                rows.append(format_one(now, turns))  # type: ignore[arg-type]
                held += len(rows[-1]["formatted"])
                if not keep_text:
                    rows[-1] |= {"formatted": None, "spans": None}

        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if conv != now:
                    close()
                    now, turns = conv, []
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                turns.append((role or "", text or ""))
        close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def format_conversations(spark: SparkSession, conversations: DataFrame, keep_text: bool = True) -> DataFrame:
    """One row per conv_id: formatted text, spans of turns and of the loss mask, figures read back.

    Turns are taken by turn number (null first), equal numbers by role and text. A null
    role or text is empty; rows with a null conv_id are one conversation. Empty texts
    keep their turn. Repeated rows are turns of their own. Further columns are ignored;
    an empty table gives no rows. Without ``keep_text`` formatted and spans are null.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(spark)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.col("turn").cast("long").alias("turn"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = to_arrow_schema(spark.createDataFrame([], FORMATTED).schema)
    return dealt.select("conv_id", "role", "text").mapInArrow(_stream(schema, keep_text), FORMATTED)
