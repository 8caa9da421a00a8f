"""Chat formatting at token level.

A turn is `<|im_start|>` role newline text `<|im_end|>` newline. The marks are
ids of their own behind the vocabulary and are spliced between the segments,
each of which is encoded alone. So no text can make a mark; control strings that
occur in a text are escaped all the same, so that the rendered string can be
read back too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varigrove.llm import pieces
from varigrove.llm.common import PYTHON_ROWS, quoted
from varigrove.llm.token_files import Encoder

#: Fixed strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    """No `<|` is left: every one gets a backslash inside, and so does every one that has some already."""
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role ends at a newline; one inside it becomes `<|n`, which an escaped text never has."""
    return escape(role).replace("\n", "<|n")


def unescape_role(role: str) -> str:
    return unescape(role.replace("<|n", "\n"))


class Template:
    """Token ids and loss mask of turns, and the way back."""

    _loaded: dict[str, Template] = {}

    def __init__(self, path: str):
        self.encoder = Encoder.of(path)
        bytes_of = {letter: b for b, letter in enumerate(pieces.byte_letters())}
        self.start = max(self.encoder.vocabulary.values()) + 1
        self.end = self.start + 1
        self.of_id = {n: bytes(bytes_of[c] for c in t) for t, n in self.encoder.vocabulary.items() if all(c in bytes_of for c in t)}

    @classmethod
    def of(cls, path: str) -> Template:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoder(text), self.encoder.type).astype(np.int32)

    def turn(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a turn, and 1 where the loss counts: the text of the assistant."""
        mark = lambda x: np.array([x], np.int32)
        segments = [mark(self.start), self.encode(escape_role(role) + "\n"), self.encode(escape(text)), mark(self.end), self.encode("\n")]
        ends = np.cumsum([len(s) for s in segments])
        steps = np.zeros(ends[-1] + 1, np.int8)
        if role == TRAINED:
            steps[ends[1]] += 1
            steps[ends[2]] -= 1
        return np.concatenate(segments), np.cumsum(steps[:-1], dtype=np.int8)

    def text(self, ids: np.ndarray) -> str:
        return b"".join(map(self.of_id.__getitem__, ids.tolist())).decode("utf-8")

    def read(self, ids: np.ndarray) -> tuple[str, str, int]:
        """Role, text and length in characters of a rendered turn."""
        if len(ids) < 3 or ids[0] != self.start or ids[-2] != self.end:
            raise ValueError("a turn lacks its marks")
        inside, after = self.text(ids[1:-2]), self.text(ids[-1:])
        role, text = inside.split("\n", 1)
        return unescape_role(role), unescape(text), len(START) + len(inside) + len(END) + len(after)


def format_turns(
    rows: DataFrame, path: str, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn: conv_id, nth, at, ids, mask.

    `nth` counts the turns of a conversation from 0 and `at` the ids before it,
    so a conversation is its rows in order of `nth`, end to end. Turns come in
    order of `turn` (null last), then role, then text. Null roles and texts are
    empty; rows without a conversation are one conversation; repeated rows are
    turns of their own. Other columns are not read. A task holds one batch of
    turns and never a conversation.
    """
    shown = rows.select(
        quoted(conversation).cast("long").alias("conv_id"),
        quoted(turn).alias("turn"),
        F.coalesce(quoted(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"),
    )
    ordered = shown.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template.of(path)
        now, nth, at = object(), 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, PYTHON_ROWS):
                part = batch.slice(start, PYTHON_ROWS)
                convs = part.column(0).to_pylist()
                nths, ats, ids, masks = [], [], [], []
                for conv, who, what in zip(convs, part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    if conv != now:
                        now, nth, at = conv, 0, 0
                    found, mask = template.turn(who, what)
                    nths.append(nth)
                    ats.append(at)
                    ids.append(found)
                    masks.append(mask)
                    nth += 1
                    at += len(found)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(nths, pa.int64()), pa.array(ats, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))],
                    names=["conv_id", "nth", "at", "ids", "mask"],
                )

    return ordered.select("conv_id", F.lit(0), "role", "text").mapInArrow(convert, "conv_id long, nth long, at long, ids array<int>, mask array<tinyint>")


def read_turns(turns: DataFrame, path: str) -> DataFrame:
    """What formatted turns say, one row per conversation.

    conv_id, n_turns, turns_sha256 (of role, newline, text, newline for each),
    loss_chars and loss_sha256 (of the text under the mask), formatted_chars (of
    the rendered string). Turns stream by; only digests are held.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "nth")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template.of(path)
        done: list[tuple] = []
        state: list | None = None  # conversation, turns, hash, loss characters, loss hash, formatted characters, ids

        def close() -> None:
            if state is not None:
                done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * len(names)
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            done.clear()
            return out

        for batch in batches:
            for start in range(0, batch.num_rows, PYTHON_ROWS):
                part = batch.slice(start, PYTHON_ROWS)
                convs, ats = part.column(0).to_pylist(), part.column(2).to_pylist()
                for n, conv in enumerate(convs):
                    if state is None or conv != state[0]:
                        close()
                        state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                    ids = part.column(3)[n].values.to_numpy()
                    mask = part.column(4)[n].values.to_numpy()
                    if ats[n] != state[6]:
                        raise ValueError("a turn is missing")
                    role, text, length = template.read(ids)
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    if mask.any():
                        learnt = unescape(template.text(ids[mask == 1]))
                        state[3] += len(learnt)
                        state[4].update(learnt.encode())
                    state[5] += length
                    state[6] += len(ids)
                yield flush()
        close()
        yield flush()

    return ordered.mapInArrow(
        convert, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
