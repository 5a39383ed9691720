"""Chat formatting on tokens.

Each turn is ``<|im_start|>role`` newline ``text<|im_end|>`` newline. The texts between the marks are encoded
separately; the marks are reserved ids behind the vocabulary, so no text can produce one. Inside texts a control
string is escaped all the same (``<|`` gets a backslash, ``<\\|`` another one), which keeps the printed form
unambiguous and can be undone. The loss mask covers the texts of assistant turns: their first and last positions
come from prefix sums over segment lengths.

A conversation is a run of pieces of bounded length, so a conversation that holds a third of all rows needs no
more memory than others: its turns stream, in order, through the task that owns it.

Rules
* Turns are ordered by turn (null last), then role, then text; repeated turns are all kept.
* A null text or role is empty. In roles, backslash and newline are escaped as well. Rows with a null id form one
  conversation. An empty table gives no rows; other columns and clashing names play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm.token_counts import load_tokenizer

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"

PIECE_TOKENS = 1 << 18  # a piece is closed with the turn that reaches this length


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Template:
    """Encodes turns and reads them back."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.tokenizer.encode_special_tokens = True  # their strings inside texts are ordinary text
        self.start = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.end = self.start + 1
        self.known: dict[str, np.ndarray] = {}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def short(self, text: str) -> np.ndarray:
        """Like ``encode``, remembered: for role lines."""
        if text not in self.known:
            if len(self.known) > 10_000:
                self.known.clear()
            self.known[text] = self.encode(text)
        return self.known[text]

    def turns(self, roles: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, mask, ends)`` of turns in a row; ``ends`` are the positions where turns end."""
        encoded = self.tokenizer.encode_batch([escape(t) for t in texts], add_special_tokens=False)
        mark, stop, line = np.array([self.start], np.int32), np.array([self.end], np.int32), self.short("\n")
        segments: list[np.ndarray] = []
        for role, text in zip(roles, encoded):
            segments += [mark, self.short(escape_role(role) + "\n"), np.array(text.ids, np.int32), stop, line]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in segments])])
        first, last = bounds[2:-1:5], bounds[3::5]  # of the texts
        trained = np.array([r == TRAINED_ROLE for r in roles], bool)
        change = np.zeros(bounds[-1] + 1, np.int32)
        np.add.at(change, first[trained], 1)
        np.add.at(change, last[trained], -1)
        return np.concatenate(segments), np.cumsum(change[:-1]).astype(bool), bounds[5::5]

    def decode(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def read(self, ids: np.ndarray, mask: np.ndarray) -> Iterator[tuple[str, str, str]]:
        """``(role, text, text under the mask)`` of each turn in ``ids``."""
        starts, ends = np.flatnonzero(ids == self.start), np.flatnonzero(ids == self.end)
        for start, end in zip(starts, ends):
            role, _, text = self.decode(ids[start + 1 : end]).partition("\n")
            under = mask[start + 1 : end]
            masked = self.decode(ids[start + 1 : end][under]) if under.any() else ""
            yield unescape_role(role), unescape(text), unescape(masked)

    def printed(self, ids: np.ndarray) -> str:
        """The formatted text."""
        marks = {self.start: START, self.end: END}
        cuts = np.flatnonzero(ids >= self.start)
        out, at = [], 0
        for cut in cuts:
            out += [self.decode(ids[at:cut]), marks[int(ids[cut])]]
            at = cut + 1
        return "".join([*out, self.decode(ids[at:])])


def in_order(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, role, text`` with each conversation whole and in order in one partition, spilling as needed."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    slim = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    ordered = slim.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_last("turn"), "role", "text")
    return ordered.select("conv", "role", "text")


def _runs(values: list) -> Iterator[tuple[object, int, int]]:
    at = 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] != values[at]:
            yield values[at], at, i
            at = i


def format_conversations(
    turns: DataFrame,
    tokenizer_path: str,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv, piece, ids, mask``: the pieces of each conversation follow each other in one partition."""
    ordered = in_order(turns, conv_col, turn_col, role_col, text_col)
    names = ["conv", "piece", "ids", "mask"]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, kind = Template(tokenizer_path), None
        open_conv, piece, held = object(), 0, []  # no conversation yet

        def close():
            ids, mask = (np.concatenate(p) for p in zip(*held))
            columns = [pa.array([open_conv], kind), pa.array([piece], pa.int64()), pa.array([ids], pa.list_(pa.int32())), pa.array([mask], pa.list_(pa.bool_()))]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            kind = batch["conv"].type
            roles, texts = batch["role"].to_pylist(), batch["text"].to_pylist()
            for conv, first, last in _runs(batch["conv"].to_pylist()):
                if conv != open_conv:
                    if held:
                        yield close()
                    open_conv, piece, held = conv, 0, []
                ids, mask, ends = template.turns(roles[first:last], texts[first:last])
                begin = 0
                for end in ends:
                    held.append((ids[begin:end], mask[begin:end]))
                    begin = end
                    if sum(len(i) for i, _ in held) >= PIECE_TOKENS:
                        yield close()
                        piece, held = piece + 1, []
                if len(held) > 64:
                    held = [tuple(np.concatenate(p) for p in zip(*held))]
        if held:
            yield close()

    kind = ordered.schema["conv"].dataType.simpleString()
    return ordered.mapInArrow(assemble, f"conv {kind}, piece long, ids array<int>, mask array<boolean>")


def read_back(pieces: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of each conversation, read from its pieces as ``format_conversations`` leaves them."""
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, kind, conv, state = Template(tokenizer_path), None, None, None

        def close():
            turns, all_text, chars, loss, printed = state
            values = [conv, turns, all_text.hexdigest(), chars, loss.hexdigest(), printed]
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names)

        for batch in batches:
            kind = batch["conv"].type
            for own, piece, ids, mask in zip(batch["conv"].to_pylist(), batch["piece"].to_pylist(), batch["ids"], batch["mask"]):
                if piece == 0:
                    if state:
                        yield close()
                    conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
                for role, text, masked in template.read(ids, mask):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(template.printed(ids))
        if state:
            yield close()

    kind = pieces.schema["conv"].dataType.simpleString()
    return pieces.mapInArrow(
        read, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
