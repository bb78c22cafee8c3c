"""Chat formatting with typed content parts, and reading a formatted conversation back."""

from __future__ import annotations

import hashlib
import math
import re
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import small_batches

#: One content part of a turn. `text` is used by text parts, `uri` by the others; sizes are pixels, seconds and pages.
PART = "struct<kind string, text string, uri string, width int, height int, seconds double, pages int>"
PARTS = f"array<{PART}>"

#: Tokens a part expands to: one for each started square of PATCH pixels, each started second and page.
PATCH, TOKENS_PER_SECOND, TOKENS_PER_PAGE = 14, 25, 1024

#: The template: <turn:role> content </turn> newline; parts that are not text stand as <kind:number>.
END = "</turn>\n"


def escape(text: str) -> str:
    """Control strings need < or >, so those two and the escape character itself get a backslash in front."""
    return re.sub(r"([\\<>])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _size(value) -> float:
    """A size that counts: nothing below zero, missing or not a finite number."""
    return value if value is not None and math.isfinite(value) and value > 0 else 0


#: What a part expands to, by kind; a kind that is not listed is an attachment of no tokens.
VISITORS: dict[str, Callable[[dict], int]] = {
    "image": lambda part: math.ceil(_size(part.get("width")) / PATCH) * math.ceil(_size(part.get("height")) / PATCH),
    "audio": lambda part: math.ceil(_size(part.get("seconds")) * TOKENS_PER_SECOND),
    "document": lambda part: int(_size(part.get("pages"))) * TOKENS_PER_PAGE,
}


def visit(role: str, parts: list[dict | None], trained: bool) -> dict:
    """One formatted turn: its text, the loss mask as ranges of code points of it, and the attachments in the order of their placeholders."""
    pieces, mask, attachments = [f"<turn:{escape(role)}>"], [], []
    at = len(pieces[0])
    for part in parts:
        part = part or {}
        kind = part.get("kind") or "text"
        if kind == "text":
            piece = escape(part.get("text") or "")
            if trained and piece:
                mask.append({"start": at, "end": at + len(piece)})
        else:
            piece = f"<{escape(kind)}:{len(attachments)}>"
            attachments.append({"number": len(attachments), "kind": kind, "uri": part.get("uri"),
                                "tokens": min(VISITORS[kind](part) if kind in VISITORS else 0, (1 << 63) - 1)})
        pieces.append(piece)
        at += len(piece)
    return {"formatted": "".join(pieces) + END, "mask": mask, "attachments": attachments}


def text_part(text: Column) -> Column:
    """The parts of a turn that holds only text."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"))).cast(
        "array<struct<kind string, text string>>")


TURN = ("struct<formatted string, mask array<struct<start: int, end: int>>, attachments array<struct<number: int, kind: string, uri: string, "
        "tokens: bigint>>>")


def format_turns(turns: DataFrame, parts: Column, trained: Column | None = None) -> DataFrame:
    """(conv_id, turn, formatted, mask, attachments): every turn formatted on its own.

    A formatted conversation is the concatenation of its turns in order. `parts` is an array of PART (missing fields read as
    null); text, image, audio and document parts become ordered content, the last three as placeholders <kind:number> numbered
    from 0 within the turn, each with an entry (number, kind, uri, tokens) in `attachments`. `mask` has the ranges (start, end) of
    `formatted`, in code points, that are under the loss: the escaped texts of turns for which `trained` holds (default: role assistant), none of
    the template's own marks and no placeholders. No shuffle: a conversation may hold any share of all rows, and a turn any number of parts.

    Null texts, roles and parts are empty; a null turn sorts first; an unknown kind is an attachment of 0 tokens. An empty table
    gives no rows; other columns are not read.
    """
    counts = F.coalesce(F.col("role") == "assistant" if trained is None else trained, F.lit(False))
    rows = small_batches(turns).select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce(parts, F.array()).alias("parts"),
                                       counts.alias("trained"))
    kind = to_arrow_type(T.DataType.fromDDL(TURN))

    @F.arrow_udf(TURN)
    def visited(roles: pa.Array, parts: pa.Array, trained: pa.Array) -> pa.Array:
        return pa.array([visit(*x) for x in zip(roles.to_pylist(), parts.to_pylist(), trained.to_pylist())], kind)

    return rows.select("conv_id", "turn", visited("role", "parts", "trained").alias("v")).select("conv_id", "turn", "v.*")


#: A role, then escaped characters, plain runs and placeholders up to the end of the turn.
_HEAD = re.compile(r"<turn:((?:[^\\<>]|\\.)*)>", re.S)
_PIECE = re.compile(r"[^\\<>]+|\\(.)|</turn>\n|<(?:[^\\<>]|\\.)*>", re.S)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn in a formatted text, unescaped; placeholders are left out of the text."""
    at = 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        if not head:
            raise ValueError(f"no turn at {at}")
        at, said = head.end(), []
        while True:
            piece = _PIECE.match(formatted, at)
            if not piece:
                raise ValueError(f"no content at {at}")
            at = piece.end()
            if piece[0] == END:
                break
            if piece[1] is not None:
                said.append(piece[1])
            elif piece[0][0] != "<":
                said.append(piece[0])
        yield unescape(head[1]), "".join(said)


SUMMARY = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, "
           "attachment_tokens long")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_attachments, attachment_tokens) from formatted turns.

    Roles and texts are parsed from the formatted text; the text under the loss is cut from it by the mask's ranges and unescaped.
    Turns meet sorted by (conv_id, turn) and are parsed as a stream: a task holds one Arrow batch and the running digests of one
    conversation, never a conversation. Rows with an equal turn are ordered by their formatted text. The digests are of one
    sequence each, so the turns of one conversation pass one task, however many.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    rows = formatted.select("conv_id", "turn", "formatted", "mask", F.size("attachments").alias("n"), F.aggregate(
        "attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"]).alias("tokens")).repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "formatted").select("conv_id", "formatted", "mask", "n", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *(f.split()[0] for f in SUMMARY.split(", "))]
        current, state = None, None

        def summary():
            count, turns, chars, loss, *sums = state
            return [current, count, turns.hexdigest(), chars, loss.hexdigest(), *sums]

        for batch in batches:
            out = []
            for conv, text, mask, n, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != current:
                    if state is not None:
                        out.append(summary())
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in mask:
                    said = unescape(text[span["start"]:span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
                state[5] += n
                state[6] += tokens
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field(0).type if i == 0 else None)
                                                  for i, c in enumerate(zip(*out))], names)
            kept = batch.schema.field(0).type
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], kept if i == 0 else None) for i, v in enumerate(summary())], names)

    return rows.mapInArrow(run, f"conv_id {kind}, {SUMMARY}")
