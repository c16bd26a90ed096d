"""Chat formatting with turn spans found by incremental rendering.

The template is a black box: a function from a list of (role, text) to the formatted text.  Successive prefixes of a
conversation are rendered; where the output for k turns begins with the output for k - 1 turns, the rest is turn k's
span.  Where it does not, the template rewrites history, and the conversation is reported so instead of being given wrong
spans.  A turn's text is located inside its span by rendering the prefix once more with a probe character as that text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

PROBE = "\ue000"  # a private-use character, which no template knows
#: Characters that control strings are made of, and how a text shows them.
ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"}
UNESCAPES = {shown: char for char, shown in ESCAPES.items()}
ESCAPED = re.compile(r"\\[\\hlc]")
HEADER = re.compile(r"### ([^:]*): ")


def escape(text: str, characters: str = "\\#<") -> str:
    for char in characters:  # the backslash comes first
        text = text.replace(char, ESCAPES[char])
    return text


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: UNESCAPES[m[0]], text)


def marked_turns(turns: list[Turn]) -> str:
    """``### role: text</turn>`` and a line end for each turn; no control string can occur inside a role or a text."""
    return "".join([f"### {escape(role, ''.join(ESCAPES))}: {escape(text)}</turn>\n" for role, text in turns])


def parse_marked(formatted: str) -> list[Turn]:
    """The inverse of ``marked_turns``."""
    turns = []
    for block in formatted.split("</turn>\n")[:-1]:
        header = HEADER.match(block)
        turns.append((unescape(header[1]), unescape(block[header.end() :])))
    return turns


@dataclass
class Spans:
    """Where the turns lie in ``formatted`` (code points); empty lists where the template rewrites history."""

    formatted: str
    rewrites_history: bool = False
    turn_start: list[int] = field(default_factory=list)
    text_start: list[int] = field(default_factory=list)
    text_end: list[int] = field(default_factory=list)
    turn_end: list[int] = field(default_factory=list)


def locate(turns: list[Turn], template: Template) -> Spans:
    found, before = Spans(""), ""
    for k in range(1, len(turns) + 1):
        after = template(turns[:k])
        probed = template([*turns[: k - 1], (turns[k - 1][0], PROBE)])
        at = probed.find(PROBE, len(before))
        tail = len(probed) - at - len(PROBE)
        fits = at >= 0 and after.startswith(before) and after[:at] == probed[:at] and after.endswith(probed[at + len(PROBE) :])
        if not fits or len(after) - tail < at:
            return Spans(template(turns), rewrites_history=True)
        found.turn_start.append(len(before))
        found.text_start.append(at)
        found.text_end.append(len(after) - tail)
        found.turn_end.append(len(after))
        before = after
    found.formatted = before
    return found


SCHEMA = (
    "conv_id long, formatted string, rewrites_history boolean, roles array<string>, turn_start array<long>, "
    "text_start array<long>, text_end array<long>, turn_end array<long>"
)


def format_conversations(conversations: DataFrame, template: Template) -> DataFrame:
    """One row per conversation of ``conversations`` (conv_id, turn, role, text): its formatted text and the spans of its turns.

    Turns are ordered by ``turn`` (null first), ties by role and text; repeated rows are turns of their own.  Null texts and
    roles are empty; rows without conv_id form one conversation, without id; an empty table gives no rows.

    Conversations are spread by id and read in order, so a task holds one conversation at a time, not those of a
    key group.  A template sees whole prefixes, so a single conversation is not split.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, turns = None, []
        done: list[dict] = []

        def finish() -> None:
            if turns:
                spans = locate(turns, template)
                done.append({"conv_id": current, "roles": [r for r, _ in turns], **vars(spans)})

        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != current:
                    finish()
                    current, turns = conv_id, []
                turns.append((role, text))
            yield pa.RecordBatch.from_pylist(done, schema=OUT)
            done = []
        finish()
        yield pa.RecordBatch.from_pylist(done, schema=OUT)

    return ordered.mapInArrow(run, SCHEMA)


OUT = pa.schema(
    [("conv_id", pa.int64()), ("formatted", pa.string()), ("rewrites_history", pa.bool_()), ("roles", pa.list_(pa.string()))]
    + [(c, pa.list_(pa.int64())) for c in ("turn_start", "text_start", "text_end", "turn_end")]
)

DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "rewrites_history boolean"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask (assistant texts), read from texts made by ``marked_turns``.

    Roles and texts come from the formatted text alone, cut at the turn spans.  Conversations whose template rewrites
    history have no spans: their digests are null.
    """
    names = [c.split()[0] for c in DIGEST.split(", ")]

    def digest(row: dict) -> tuple:
        text = row["formatted"]
        if row["rewrites_history"]:
            return row["conv_id"], None, None, None, None, len(text), True
        turns, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
        for a, b, c, d in zip(*(row[c] for c in ("turn_start", "text_start", "text_end", "turn_end"))):
            role = unescape(HEADER.match(text[a:b])[1])
            content = unescape(text[b:c])
            turns.update(f"{role}\n{content}\n".encode())
            if role == "assistant":
                loss.update(content.encode())
                chars += len(content)
        return row["conv_id"], len(row["turn_start"]), turns.hexdigest(), chars, loss.hexdigest(), len(text), False

    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in DIGEST.split(", ")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([dict(zip(names, digest(r))) for r in batch.to_pylist()], schema=schema)

    return formatted.mapInArrow(run, DIGEST)
