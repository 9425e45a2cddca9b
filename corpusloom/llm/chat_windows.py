"""Chat formatting in budgeted windows with reversible control-string escapes.

A conversation is cut at turn borders: running sums of turn tokens choose the
longest span of new turns that fits the budget next to the system turn and a
limited history of earlier turns. System turn and history are repeated in each
later window, marked as such, and never under the loss mask, so each assistant
text is a target exactly once.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import quoted, slices

NEW, AGAIN, END = "<|turn|>", "<|again|>", "<|end|>\n"
#: Control strings of this and other chat templates: their first and other characters.
_REST = r"\||/?s>|/?INST\]|<SYS>|</SYS>|/?im_(?:start|end)|(?:start|end)_of_turn>|(?:bos|eos|pad|unk|mask|sep|cls)>"
_CONTROL = re.compile(rf"(<|\[)(\\*)({_REST})")
_ESCAPED = re.compile(rf"(<|\[)\\(\\*)({_REST})")


def escape(text: str) -> str:
    """A backslash goes into every control string, after those that are there."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), unescape(role))


@dataclass(frozen=True)
class Windows:
    #: Tokens of a window, of which so many may be history of so many turns.
    budget: int = 1024
    history: int = 256
    history_turns: int = 4
    #: Tokens that the marks of a turn take.
    overhead: int = 4
    system: str = "system"
    target: str = "assistant"

    def tokens(self, text: str) -> int:
        return len(text.split()) + self.overhead


class _Conversation:
    """One conversation as its turns come in; holds one window and the history."""

    def __init__(self, key: int | None, how: Windows):
        self.key, self.how, self.number = key, how, 0
        self.system: tuple[str, str] | None = None
        self.system_tokens = 0
        self.history: deque[tuple[str, str, int]] = deque(maxlen=how.history_turns)
        self.new: list[tuple[str, str]] = []
        self.prefix = self.begun = 0  # running token sums: now, and where the window's new turns begin
        self.kept = 0  # tokens of history in this window
        self.again: list[tuple[str, str]] = []

    def add(self, role: str, text: str) -> dict | None:
        """The window that this turn closes, if it does."""
        how, n = self.how, self.how.tokens(text)
        closed = None
        if self.new and self.system_tokens + self.kept + self.prefix + n - self.begun > how.budget:
            closed = self.close()
        if self.number == 0 and not self.new and self.prefix == 0 and role == how.system:
            self.system, self.system_tokens = (role, text), n
            self.begun = n  # counted as the system turn
        self.new.append((role, text))
        self.history.append((role, text, n))
        self.prefix += n
        return closed

    def close(self) -> dict:
        parts: list[str] = []
        loss: list[dict] = []
        at = 0

        def put(mark: str, role: str, text: str, target: bool) -> None:
            nonlocal at
            head, body = f"{mark}{_role(role)}\n", escape(text)
            if target and body:
                loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
            parts.extend((head, body, END))
            at += len(head) + len(body) + len(END)

        for role, text in self.again:
            put(AGAIN, role, text, False)
        for role, text in self.new:
            put(NEW, role, text, role == self.how.target)
        window = {"conv_id": self.key, "window": self.number, "text": "".join(parts), "loss": loss, "new_turns": len(self.new)}
        self.number += 1
        # The next window repeats the system turn and the last turns that fit.
        self.again, self.kept = [], 0
        for role, text, n in reversed(self.history):
            if self.kept + n > self.how.history or (role, text) == self.system:
                break
            self.again.insert(0, (role, text))
            self.kept += n
        if self.system is not None:
            self.again.insert(0, self.system)
        self.new, self.begun = [], self.prefix
        return window


_WINDOW = pa.schema(
    [
        ("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("new_turns", pa.int64()),
    ]
)


def format_windows(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", how: Windows = Windows()
) -> DataFrame:
    """(conv_id, window, text, loss, new_turns): windows of every conversation.

    Turns go in order of turn number (null first), then role and text, so rows
    that repeat a turn number are turns of their own. Null roles and texts are
    empty, a null conv_id is a conversation. A turn over the budget gets a
    window of its own, whole. loss: (start, end) in code points of target texts.
    Rows of a conversation stream through one task in order; the task holds one
    window and the history, never the conversation. An empty table gives no rows.
    """
    rows = df.select(
        quoted(conv_col).cast("long").alias("c"), quoted(turn_col).cast("long").alias("t"),
        F.coalesce(quoted(role_col), F.lit("")).alias("r"), F.coalesce(quoted(text_col), F.lit("")).alias("x"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Conversation | None = None
        done: list[dict] = []
        for part in slices(batches):
            for key, role, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist()):
                if current is None or current.key != key:
                    if current is not None:
                        done.append(current.close())
                    current = _Conversation(key, how)
                closed = current.add(role, text)
                if closed:
                    done.append(closed)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_WINDOW)
                done = []
        if current is not None:
            yield pa.RecordBatch.from_pylist([current.close()], schema=_WINDOW)

    ordered = rows.repartition("c").sortWithinPartitions("c", "t", "r", "x")
    return ordered.mapInArrow(run, "conv_id long, window long, text string, loss array<struct<start: long, end: long>>, new_turns long")


def parse_window(text: str) -> list[tuple[bool, str, str, int]]:
    """(repeated, role, text, start of the escaped text) of each turn of a window."""
    turns = []
    at = 0
    while at < len(text):
        again = text.startswith(AGAIN, at)
        head = at + len(AGAIN if again else NEW)
        line = text.index("\n", head)
        end = text.index(END, line + 1)
        turns.append((again, _unrole(text[head:line]), unescape(text[line + 1 : end]), line + 1))
        at = end + len(END)
    return turns


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows, n_repeated).

    Parses the formatted text alone: turns that are not marked as repeated give
    the conversation, the text under the loss mask the targets. Windows stream in
    order and digests are updated on the way.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long, n_repeated long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: int | None = None
        state: list | None = None
        done: list[tuple] = []

        def finish() -> None:
            if state is not None:
                done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5], state[6]))

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows", "n_repeated"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [()] * len(names)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

        for part in slices(batches):
            for c, text, loss in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist()):
                if state is None or c != key:
                    finish()
                    key, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for again, role, turn, _ in parse_window(text):
                    state[6] += again
                    if not again:
                        state[0] += 1
                        state[1].update(f"{role}\n{turn}\n".encode())
                for span in loss:
                    target = unescape(text[span["start"] : span["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode())
                state[4] += len(text)
                state[5] += 1
            yield flush()
        finish()
        yield flush()

    ordered = windows.select("conv_id", "window", "text", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(run, schema)
