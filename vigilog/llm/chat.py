r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are its context, and its
text alone is under the loss mask. Turns after the last reply become a closing example without
loss, so the whole conversation can be read back.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` for each turn. Inside texts and roles the start of a
control string, ``<|``, is written ``<\|``; where backslashes stand between the two characters
already, one more is added. Reading back removes one, so every text survives.

Every example is written in full, so what is written of a conversation grows with the square of
its turns. Conversations are formatted and read back as streams over sorted rows; a task holds the
text of one example and a few more that wait to be written, ``BATCH_CHARS`` at most.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role is one line, so its newlines and backslashes are written as escapes."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    plain = unescape(role)
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], plain)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of all turns in a formatted text, unescaped."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(formatted)]


EXAMPLE = (
    "example int, target int, text string, context_chars bigint, "
    "loss_start bigint, loss_end bigint, chars bigint"
)
#: Texts that are written at once.
BATCH_CHARS = 1 << 22


def examples(turns: DataFrame) -> DataFrame:
    """Examples of ``turns`` (conv_id, turn, role, text; other columns are not read).

    Columns: conv_id, example (from 0), target (place of the reply among the turns, null in a
    closing example), text (all turns up to the target, in full), context_chars (of the text before
    this example's own turns), loss_start, loss_end (places in text, null without loss), chars (of
    the text, in code points). The rows of a conversation stand together and in order.

    Null texts and roles are empty. Turns go by turn (null first); rows with the same turn by role
    and text, and repeated rows stay. Rows without conv_id are one conversation. An empty
    assistant text is an example with an empty loss span. An empty table gives an empty result.
    Texts of any length are written whole; a task holds one example's text at a time.
    """
    key = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = run  # no conversation yet
        text, before, example, place, held = "", 0, 0, 0, 0
        kind = None

        def row(target, loss):
            chars = len(text)
            start = None if loss is None else chars - len(END) - 1 - loss
            end = None if loss is None else chars - len(END) - 1
            return (current, example, target, text, before, start, end, chars)

        def batch_of(rows):
            names = ["conv_id", *[f.split()[0] for f in EXAMPLE.split(", ")]]
            types = [kind, pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        for batch in batches:
            kind, rows = batch.schema.field("conv_id").type, []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for conv, role, said in zip(*columns, strict=True):
                if conv != current:
                    if len(text) > before:
                        rows.append(row(None, None))
                    current, text, before, example, place = conv, "", 0, 0, 0
                body = escape(said or "")
                text += f"{START}{escape_role(role or '')}\n{body}{END}\n"
                if role == ASSISTANT:
                    rows.append(row(place, len(body)))
                    before, example, held = len(text), example + 1, held + len(text)
                    if held >= BATCH_CHARS:
                        yield batch_of(rows)
                        rows, held = [], 0
                place += 1
            if rows:
                yield batch_of(rows)
                held = 0
        if len(text) > before:
            yield batch_of([row(None, None)])

    return (
        turns.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(run, f"conv_id {key}, {EXAMPLE}")
    )


def read_back(made: DataFrame) -> DataFrame:
    """Digests of conversations, from the full texts of ``examples`` and the masks in them.

    Columns: conv_id, n_turns, turns_sha256 (role, newline, text, newline for each turn),
    loss_chars and loss_sha256 (all text under the loss masks in order), formatted_chars (of all
    examples' full texts). Each text is read from where the
    one before ends; that each text goes on from the
    one before, and that its mask is the last turn's text, is checked and stops the run if not.
    """
    key = made.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = run
        n = loss = formatted = 0
        last = ""
        turns, masked = hashlib.sha256(), hashlib.sha256()
        kind = None

        def result():
            return (current, n, turns.hexdigest(), loss, masked.hexdigest(), formatted)

        def batch_of(rows):
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
            )

        columns = ("conv_id", "text", "loss_start", "loss_end")
        for batch in batches:
            kind, rows = batch.schema.field("conv_id").type, []
            # One text at a time: a batch of long ones is large enough as it is.
            for conv, full, start, end in zip(*(batch.column(c) for c in columns), strict=True):
                conv, full, start, end = conv.as_py(), full.as_py(), start.as_py(), end.as_py()
                if conv != current:
                    if n:
                        rows.append(result())
                    current, n, loss, formatted, last = conv, 0, 0, 0, ""
                    turns, masked = hashlib.sha256(), hashlib.sha256()
                if not full.startswith(last):
                    raise ValueError(f"an example of conversation {conv} does not start with the one before")
                own = parse(full[len(last) :])
                for role, text in own:
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    text = unescape(full[start:end])
                    if own[-1] != (ASSISTANT, text):
                        raise ValueError(f"a mask of conversation {conv} is not its reply")
                    loss += len(text)
                    masked.update(text.encode("utf-8", "surrogatepass"))
                formatted += len(full)
                last = full
            if rows:
                yield batch_of(rows)
        if n:
            yield batch_of([result()])

    schema = (
        f"conv_id {key}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint"
    )
    return made.mapInArrow(run, schema)
