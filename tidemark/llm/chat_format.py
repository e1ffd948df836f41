"""Chat formatting by event-sourced reconstruction.

The log has events (conv_id, turn, seq, role, kind, text). Events are dealt by
conversation and sorted by (turn, seq) within a partition, and one streaming
pass folds them into final messages:

- `message` opens a message of its role with its text,
- `delta` appends to the open message of the turn,
- `edit` replaces the text of the turn's open message,
- `regenerate` empties it, so that later deltas build the new answer.

A delta, edit or regenerate for a turn without an open message opens one.
Messages are rendered as they close, `### role: text</turn>` and a line end, in
pieces of at most `piece_chars` characters (or one message), so neither a long
conversation nor a hot one is ever held whole; only one message is.

Control strings inside roles and texts are escaped reversibly: a backslash
doubles, each # of a run of three or more gets a backslash before it (in roles
also ":"), and "</turn>" becomes "<\\/turn>". Taking each backslash away and
keeping what follows it gives the text back. The loss mask of a piece is the
list of [start, end) offsets of the escaped texts of `learn_from` roles.

Null text and null role count as empty, a null turn sorts first, null conv_id
is a conversation of its own, ties of (turn, seq) are ordered by role, kind and
text. An empty log gives no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PIECES = "conv_id long, piece long, text string, mask array<struct<start:long,end:long>>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
HEAD, END = "### ", "</turn>\n"
MESSAGE = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|(?!</turn>)[^\\])*)</turn>\n", re.DOTALL)


def escape(text: str, role: bool = False) -> str:
    text = re.sub("#{3,}", lambda m: "\\#" * len(m[0]), text.replace("\\", "\\\\")).replace("</turn>", "<\\/turn>")
    return text.replace(":", "\\:") if role else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered message and where its escaped text starts and ends in it."""
    head, body = f"{HEAD}{escape(role, role=True)}: ", escape(text)
    return head + body + END, len(head), len(head) + len(body)


def messages(events: Iterator[tuple]) -> Iterator[tuple[int | None, str, str]]:
    """(conv_id, role, text) of each message, from sorted events (conv_id, turn, role, kind, text)."""
    at, role, parts = None, "", []
    for conv, turn, who, kind, text in events:
        if kind == "message" or at != (conv, turn):
            if at is not None:
                yield at[0], role, "".join(parts)
            at, role, parts = (conv, turn), who or "", []
        if kind in ("edit", "regenerate"):
            parts.clear()
        if kind != "regenerate":
            parts.append(text or "")
    if at is not None:
        yield at[0], role, "".join(parts)


def format_chats(log: DataFrame, learn_from: tuple[str, ...] = ("assistant",), piece_chars: int = 1_000_000) -> DataFrame:
    """The rendered conversations: conv_id, piece (0, 1, ..), text, mask; pieces of a conversation are adjacent and in order."""
    order = ["conv_id", "turn", "seq", "role", "kind", "text"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def events():
            for b in batches:
                yield from zip(*(b.column(k).to_pylist() for k in range(5)), strict=True)

        out: list[tuple] = []
        conv, piece, buffer, mask, chars, held = None, -1, [], [], 0, 0
        for c, role, text in messages(events()):
            if piece < 0 or c != conv or chars > piece_chars:
                if piece >= 0:
                    out.append((conv, piece, "".join(buffer), mask))
                    held += chars
                    if held > 4 * piece_chars or len(out) >= 4096:
                        yield batch(out)
                        out, held = [], 0
                piece = piece + 1 if piece >= 0 and c == conv else 0
                conv, buffer, mask, chars = c, [], [], 0
            shown, start, end = render(role, text)
            if role in learn_from:
                mask.append({"start": chars + start, "end": chars + end})
            buffer.append(shown)
            chars += len(shown)
        if piece >= 0:
            out.append((conv, piece, "".join(buffer), mask))
            yield batch(out)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["conv_id", "piece", "text", "mask"])

    ordered = log.select(*[F.col(c) for c in order]).repartition("conv_id").sortWithinPartitions(*order)
    return ordered.select("conv_id", "turn", "role", "kind", "text").mapInArrow(fold, PIECES)


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from rendered pieces as format_chats() orders them."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, state = [], None

        def close():
            conv, n, turns, loss_n, loss, chars = state
            rows.append((conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))

        def flush():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            for conv, piece, text, mask in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if piece == 0:
                    if state is not None:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for m in MESSAGE.finditer(text):
                    state[1] += 1
                    state[2].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                for span in mask:
                    learned = unescape(text[span["start"] : span["end"]])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
            if len(rows) >= 4096:
                yield flush()
                rows.clear()
        if state is not None:
            close()
        if rows:
            yield flush()

    return pieces.mapInArrow(parse, DIGESTS)


def log_of(conversations: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log of `message` events."""
    return conversations.select("conv_id", "turn", F.lit(0).alias("seq"), "role", F.lit("message").alias("kind"), "text")
