"""Chat formatting by incremental black-box rendering.

A template is any function from a list of messages to text. The prefixes of a conversation
are rendered one turn longer each time and consecutive outputs compared: what is new is the
turn's span. An output that does not begin with the one before has rewritten history, which is
reported. Where a turn's text lies in its span is found by rendering the turn with
two other texts.

Turns are range-partitioned by conversation and turn, so that even a conversation with a large
share of all rows spreads over tasks. If a template is declared ``local`` (a turn's output
depends on that turn alone, apart from the start) and a probe agrees, long conversations are rendered in slices of
``slice_turns`` turns; otherwise a conversation is rendered whole, in one task, as no probe can
show what a template does with other texts.

Defined cases: null roles and texts are empty; a null turn comes first; equal turns order by role
and text; repeated rows are turns of their own; a null conversation id is one conversation; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import stored

Messages = list[tuple[str, str]]
Template = Callable[[Messages], str]

START, END = "<|im_start|>", "<|im_end|>"


def local(template: Template) -> Template:
    """Declares that each turn's output depends on that turn alone, whatever the texts."""
    template.local = True
    return template


# --------------------------------------------------------------------------
# A template that can be read back
# --------------------------------------------------------------------------
def escape(text: str) -> str:
    """No control string is left in the result, and ``unescape`` gives ``text`` again."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|") if "\\" in text or "<|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


@local
def marked_turns(messages: Messages) -> str:
    """Each turn between start and end marks, its role on a line of its own."""
    return "".join(f"{START}{escape(r).replace(chr(10), chr(92) + 'n')}\n{escape(t)}{END}\n" for r, t in messages)


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def read_turns(formatted: str) -> Messages:
    """The turns that ``marked_turns`` wrote."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


# --------------------------------------------------------------------------
# Incremental rendering
# --------------------------------------------------------------------------
def common_prefix(a: str, b: str) -> int:
    return len(a) if b.startswith(a) else len(os.path.commonprefix((a, b)))


def turn_spans(template: Template, messages: Messages, before: Messages | None = None) -> tuple[str, list[tuple[int, int]], int]:
    """``(text, spans, rewritten)``: the last output, each turn's span, and how many outputs changed
    what earlier ones had said. ``before`` is rendered ahead and cut off."""
    before = before or []
    head = template(before) if before else ""
    last, spans, rewritten = head, [], 0
    for k in range(len(messages)):
        out = template(before + messages[: k + 1])
        same = common_prefix(last, out)
        if same < len(last):
            rewritten += 1
            spans = [(min(a, same), min(b, same)) for a, b in spans]
        spans.append((same, len(out)))
        last = out
    cut = len(head)
    return last[cut:], [(max(0, a - cut), max(0, b - cut)) for a, b in spans], rewritten


def text_margins(template: Template, role: str, before: Messages) -> tuple[int, int]:
    """Characters of a turn's span before and after its text, from two other texts."""
    head = len(template(before)) if before else 0
    one, two = (template([*before, (role, t)])[head:] for t in ("x", "yy"))
    left = common_prefix(one, two)
    right = common_prefix(one[left:][::-1], two[left:][::-1])
    return left, right


def is_local(template: Template) -> bool:
    """Whether the template is declared ``local`` and a turn's output is the same at the start and after
    other turns on a probe conversation."""
    if not getattr(template, "local", False):
        return False
    probe = [(r, t) for r in ("system", "user", "assistant", "user", "tool") for t in ("a", "", f"{r} b", "c\n")]
    anchor = [("user", "")]
    whole, spans, rewritten = turn_spans(template, probe)
    if rewritten:
        return False
    try:
        parts = [turn_spans(template, probe[k : k + 3], anchor) for k in range(0, len(probe), 3)]
    except Exception:  # a template may refuse such an order
        return False
    return not any(p[2] for p in parts) and "".join(p[0] for p in parts) == whole


SLICE = T.StructType(
    [
        T.StructField("part", T.IntegerType()), T.StructField("slice", T.LongType()), T.StructField("edge", T.BooleanType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("turns", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("loss", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("rewritten", T.LongType()),
    ]
)
_PAIRS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_KINDS = [pa.int32(), pa.int64(), pa.bool_(), pa.string(), _PAIRS, _PAIRS, pa.int64()]


def _render_batches(
    batches: Iterator[pa.RecordBatch], template: Template, loss_roles: tuple, slice_turns: int | None
) -> Iterator[pa.RecordBatch]:
    """Rows (conv, turn, role, text) sorted, as slices; ``edge``: more of the conversation may follow elsewhere."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    margins: dict = {}

    def rendered(messages: Messages, whole: bool) -> tuple:
        before = [] if whole else [("user", "")]
        text, spans, rewritten = turn_spans(template, messages, before)
        loss = []
        for k, ((role, _), (a, b)) in enumerate(zip(messages, spans)):
            if role in loss_roles:
                if slice_turns is None:
                    left, right = text_margins(template, role, messages[:k])
                else:
                    if role not in margins:
                        margins[role] = text_margins(template, role, before)
                    left, right = margins[role]
                loss.append({"start": min(a + left, b), "end": max(min(a + left, b), b - right)})
        return text, [{"start": a, "end": b} for a, b in spans], loss, rewritten

    convs, rows, kind = [], [], None

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(convs, kind), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(_KINDS))],
            names=["conv_id", *SLICE.names],
        )
        convs.clear()
        rows.clear()
        return out

    nothing = object()
    conv, messages, number, first_here = nothing, [], 0, True

    def close(last_here: bool) -> None:
        nonlocal number
        edge = first_here or last_here or number > 0
        convs.append(conv)
        rows.append((part, number, edge, *rendered(messages, slice_turns is None)))

    for batch in batches:
        kind = batch.schema.field(0).type
        columns = [batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()]
        for c, role, text in zip(*columns):
            if conv is nothing or c != conv:
                if conv is not nothing:
                    close(False)
                    first_here = False
                conv, messages, number = c, [], 0
            elif slice_turns and len(messages) >= slice_turns:
                close(True)
                number += 1
                messages = []
            messages.append((role or "", text or ""))
        if len(rows) >= 200:
            yield flush()
    if conv is not nothing:
        close(True)
    if rows:
        yield flush()


def render_conversations(
    turns: DataFrame, template: Template = marked_turns, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", loss_roles: tuple[str, ...] = ("assistant",), slice_turns: int = 128,
) -> DataFrame:
    """Slices ``(conv_id, part, slice, edge, formatted, turns, loss, rewritten)``: the formatted text in
    order of ``part`` and ``slice``, spans of turns and of text under the loss mask within it (code
    points), and how often history was rewritten. A conversation without ``edge`` is one slice."""
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    sliced = is_local(template)
    order = ["conv_id", "turn", "role", "text"]
    # ranges by the short keys alone, as Spark samples them on the driver
    parted = rows.repartitionByRange(*order[:3]) if sliced else rows.repartition("conv_id")
    schema = T.StructType([rows.schema["conv_id"], *SLICE.fields])
    work = partial(_render_batches, template=template, loss_roles=loss_roles, slice_turns=slice_turns if sliced else None)
    return parted.sortWithinPartitions(*order).mapInArrow(work, schema)


# --------------------------------------------------------------------------
# Reading back
# --------------------------------------------------------------------------
_DIGEST = "conv_id {}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices, those of a conversation together and in order, to one row per conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    nothing = object()
    conv, state, out, kind = nothing, None, [], None

    def close() -> None:
        n, turns, chars, loss, formatted = state
        out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

    def flush() -> pa.RecordBatch:
        got = pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], kind), *(pa.array([r[k + 1] for r in out], t) for k, t in enumerate(kinds))], names=names
        )
        out.clear()
        return got

    for batch in batches:
        kind = batch.schema.field(0).type
        for c, text, loss in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if conv is nothing or c != conv:
                if conv is not nothing:
                    close()
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in read_turns(text):
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            for span in loss:
                said = unescape(text[span["start"] : span["end"]])
                state[2] += len(said)
                state[3].update(said.encode("utf-8", "surrogatepass"))
            state[4] += len(text)
        if len(out) >= 1000:
            yield flush()
    if conv is not nothing:
        close()
    if out:
        yield flush()


def conversation_digests(slices: DataFrame) -> DataFrame:
    """One row per conversation, read back from formatted slices of ``marked_turns``.

    Conversations of one slice stay where they are; only those that may go on elsewhere are
    brought together, in order, as a digest runs over the whole."""
    slices = stored(slices, "chat-slices")
    schema = _DIGEST.format(slices.schema["conv_id"].dataType.simpleString())
    whole = slices.where(~F.col("edge")).select("conv_id", "formatted", "loss").mapInArrow(_digest_batches, schema)
    open_ = slices.where("edge").repartition("conv_id").sortWithinPartitions("conv_id", "part", "slice")
    return whole.unionByName(open_.select("conv_id", "formatted", "loss").mapInArrow(_digest_batches, schema))
