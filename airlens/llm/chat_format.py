"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of messages to a string. The formatter
renders the turns' successive prefixes. While each output continues the one
before, what it adds is the turn's span; the same prefix rendered with a marker instead of
the turn's text shows where the text stands inside the span. A template that does
not continue its own earlier output *rewrites history*: its conversations are flagged and get no loss
mask, so nothing is trained on misplaced text.

Long conversations are formatted in windows of ``window`` turns, by which one of any
length spreads over tasks and a prefix is never longer than a window. That is allowed for
templates whose turns render alike after any prefix; every turn is checked for it, and a
template that fails is refused (use ``window=None``, which renders whole conversations).

Rows are ordered by turn, then role, then text (null first); repeated rows are turns of
their own. Null texts and roles are empty. Rows with a null conversation form one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.llm.shared import columns, map_arrow

WINDOW = 64
_MARKER = "\ue000\ue001\ue000"

Template = Callable[[list[dict]], str]

# The control strings of the default template.
_OPEN = {True: "<s>", False: "[INST]"}      # by: is it an assistant turn?
_CLOSE = {True: "</s>", False: "[/INST]"}
_CONTROL = re.compile(r"([\[<])(\\*)(/?(?:INST\]|s>))")
_ESCAPED = re.compile(r"([\[<])(\\*)\\(/?(?:INST\]|s>))")
_TURN = re.compile(r"(\[INST\]|<s>)(.*?)\n(.*?)(\[/INST\]|</s>)", re.S)


def escape(text: str) -> str:
    """A control string, or one already escaped, gets one more backslash after its first character."""
    return _CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def default_template(messages: list[dict]) -> str:
    """``<s>assistant\\n...</s>`` for answers, ``[INST]role\\n...[/INST]`` for all others; texts escaped."""
    out = []
    for m in messages:
        answer = m["role"] == "assistant"
        role = escape(m["role"].replace("\\", "\\\\").replace("\n", "\\n"))
        out.append(f"{_OPEN[answer]}{role}\n{escape(m['text'])}{_CLOSE[answer]}")
    return "".join(out)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of the default template's output."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text outside of turns")
        role = re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], unescape(m[2]))
        turns.append((role, unescape(m[3])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("text outside of turns")
    return turns


class Rewritten(Exception):
    """The template changed what it had rendered for a shorter prefix."""


def spans(template: Template, messages: list[dict], local: bool = False) -> tuple[str, list[tuple[int, int, int, int]]]:
    """The rendered messages and per turn (start, text start, text end, end).

    ``local`` also checks that each turn renders alike without what precedes it.
    """
    before, found = template([]), []
    if local and before:
        raise ValueError("the template renders something for no turns: it cannot be rendered in windows")
    for i, message in enumerate(messages):
        now = template(messages[:i + 1])
        if not now.startswith(before):
            raise Rewritten
        span = now[len(before):]
        marked = template(messages[:i] + [message | {"text": _MARKER}])
        sides = marked[len(before):].split(_MARKER)
        if not marked.startswith(before) or len(sides) != 2 or not (
                span.startswith(sides[0]) and span.endswith(sides[1]) and len(span) >= len(sides[0]) + len(sides[1])):
            raise Rewritten
        if local and i and template([message]) != span:
            raise ValueError("the template's turns depend on those before: use window=None")
        a, z = len(before), len(now)
        found.append((a, a + len(sides[0]), z - len(sides[1]), z))
        before = now
    return before, found


_PIECES = ("conv long, piece long, n_turns long, formatted string, rewrites_history boolean, "
           "loss array<struct<start:long,end:long>>")
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _piece(template: Template, conv, number: int, messages: list[dict], local: bool) -> dict:
    try:
        text, turns = spans(template, messages, local)
        loss = [{"start": t[1], "end": t[2]} for t, m in zip(turns, messages) if m["role"] == "assistant"]
        rewritten = False
    except Rewritten:
        text, loss, rewritten = template(messages), [], True
    return {"conv": conv, "piece": number, "n_turns": len(messages), "formatted": text, "rewrites_history": rewritten,
            "loss": loss}


def format_conversations(conversations: DataFrame, template: Template = default_template, window: int | None = WINDOW,
                         conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Pieces of formatted conversations: conv, piece (ascending), n_turns, formatted, rewrites_history, loss.

    ``loss`` lists the stretches of ``formatted`` (code points) that hold assistant texts. Without a window
    a conversation is one piece.
    """
    one = columns(conversations, conv, turn, role, text).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # windows are stretches of turn numbers, so rows find theirs without a shuffle by conversation
    part = F.floor(F.col("turn") / window) if window else F.lit(0)
    one = one.withColumn("part", F.coalesce(part.cast("long"), F.lit(-(1 << 31))))
    ordered = one.repartition("conv", "part").sortWithinPartitions("conv", "part", "turn", "role", "text")

    def rows(batches):
        key, messages, number = None, [], 0
        out: list[dict] = []

        def done():
            if messages:
                out.append(_piece(template, key[0], (key[1] << 24) + number, messages, window is not None))

        for batch in batches:
            for c, p, r, t in zip(*(batch.column(k).to_pylist() for k in ("conv", "part", "role", "text"))):
                if key != (c, p):
                    done()
                    key, messages, number = (c, p), [], 0
                elif window and len(messages) == window:   # many rows of one turn number
                    done()
                    messages, number = [], number + 1
                messages.append({"role": r, "text": t})
            if out:
                yield _batch(out)
                out = []
        done()
        if out:
            yield _batch(out)

    return ordered.select("conv", "part", "role", "text").transform(map_arrow, rows, _PIECES)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([
        ("conv", pa.int64()), ("piece", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
        ("rewrites_history", pa.bool_()), ("loss", _LOSS)]))


def read_digests(spark: SparkSession, path: str, conv: str = "conv_id") -> DataFrame:
    """Per conversation of the files: turns and loss digests, from the formatted text and its mask alone.

    Pieces stream through in order, so a conversation of any length needs the memory of one piece.
    """
    pieces = spark.read.schema(_PIECES).parquet(path)
    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "piece")
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"]

    def rows(batches):
        key, state, out = None, None, []

        def done():
            if state:
                out.append((key[0], state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(),
                            state["size"], state["rewritten"]))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (
                pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()))], names)

        for batch in batches:
            for c, _, _, text, rewritten, loss in zip(*(x.to_pylist() for x in batch.columns)):
                if key != (c,):
                    done()
                    key = (c,)
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "size": 0,
                             "rewritten": False}
                for role, said in parse(text):
                    state["turns"].update(f"{role}\n{said}\n".encode())
                    state["n"] += 1
                for s in loss:
                    learned = unescape(text[s["start"]:s["end"]])
                    state["loss"].update(learned.encode())
                    state["chars"] += len(learned)
                state["size"] += len(text)
                state["rewritten"] |= rewritten
            if out:
                yield batch_of(out)
                out = []
        done()
        if out:
            yield batch_of(out)

    return ordered.transform(map_arrow, 
        rows, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
              "rewrites_history boolean").withColumnRenamed("conv", conv)
