"""Token ids in length-delimited binary files with a separate offset index.

A file is a run of frames. A frame is

    length of the payload     8 bytes, little-endian
    masked CRC-32 of those    4 bytes
    payload
    masked CRC-32 of it       4 bytes

and a payload is the width of an id in bytes (1 byte), whether there is a
document id (1 byte), the document id (8 bytes) and the token ids. A checksum is
masked as it is stored next to the data it covers, so that the checksum of a
frame does not look like one of its parts.

Files are written by Arrow's file systems in the folder all executors share.
Every attempt of a task has a file of its own, and the index, which Spark
commits, names the file of the attempt that counts: what a lost or repeated
attempt leaves behind is never read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varigrove.llm import pieces
from varigrove.llm.common import KEPT, PYTHON_ROWS, quoted, saved, scratch, short_batches, trim

#: Fixed values of the frame.
MASK_DELTA = 0xA282EAD8
_LENGTH = struct.Struct("<Q")
_SUM = struct.Struct("<I")
_HEAD = struct.Struct("<BBq")
FRAME_BYTES = _LENGTH.size + 2 * _SUM.size

INDEX = "doc_id long, shard int, file string, offset long, bytes long, tokens long, before long"


def masked(data: bytes) -> int:
    """CRC-32, turned right by 15 bits, plus a constant."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _SUM.pack(masked(length)), payload, _SUM.pack(masked(payload))))


def unframe(data: bytes) -> bytes:
    """The payload of one frame; a frame that is damaged raises ValueError."""
    if len(data) < FRAME_BYTES:
        raise ValueError("a frame is cut short")
    length = data[: _LENGTH.size]
    if _SUM.unpack_from(data, _LENGTH.size)[0] != masked(length):
        raise ValueError("the checksum of a length is wrong")
    payload = data[_LENGTH.size + _SUM.size : -_SUM.size]
    if len(payload) != _LENGTH.unpack(length)[0] or _SUM.unpack_from(data, len(data) - _SUM.size)[0] != masked(payload):
        raise ValueError("the checksum of a payload is wrong")
    return payload


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return frame(_HEAD.pack(width, doc_id is not None, doc_id or 0) + ids)


def unpack(data: bytes) -> tuple[int | None, np.ndarray]:
    payload = unframe(data)
    width, known, doc_id = _HEAD.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=_HEAD.size)


class Encoder(dict):
    """Ids of whole texts as bytes, by a byte-level BPE file of the tokenizers library.

    The library's model encodes each pre-token once; this dictionary holds what
    is known of pieces (see `pieces`), without the blank they begin with. A blank
    and ASCII letters are one pre-token, which is not cut and kept here only.
    """

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        self.vocabulary: dict[str, int] = tokenizer.get_vocab(with_added_tokens=True)
        self.width = id_width(tokenizer.get_vocab_size(with_added_tokens=True))
        self.type = np.dtype(f"<u{self.width}")
        added = {t.content: np.array([n], self.type).tobytes() for n, t in tokenizer.get_added_tokens_decoder().items()}
        self.special, self.added = pieces.special_pattern(list(added)), added
        self.begins = {t[0] for t in added if t}
        self.words_are_whole = not any(t.replace(" ", "a").isalpha() for t in added)
        self.letters = dict(enumerate(pieces.byte_letters()))
        self.number = [np.array([n], self.type).tobytes() for n in range(max(self.vocabulary.values(), default=-1) + 1)]
        self.tokens: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One per Python worker, so that pieces stay known from task to task, until another operator's task ends there."""
        found = cls._loaded.get(path)
        if found is None:
            found = cls._loaded[path] = cls(path)
            trim()  # reading the file takes more memory than what it holds
        return found

    def __missing__(self, piece: str) -> bytes:
        if self.words_are_whole and piece.isascii() and piece.isalpha():
            found = self._ids(self.letters[32] + piece)
        else:
            found = self._piece(" " + piece)
        if len(piece) <= pieces.LONGEST and len(self) < pieces.KEPT_PIECES:
            self[piece] = found
        return found

    def _piece(self, text: str) -> bytes:
        if self.begins.isdisjoint(text):
            return self._part(text)
        out = []
        for i, part in enumerate(self.special.split(text)):
            out.append(self.added[part] if i % 2 else self._part(part))
        return b"".join(out)

    def _part(self, text: str) -> bytes:
        return b"".join(map(self._token, pieces.pretokens(text)))

    def _token(self, token: str) -> bytes:
        found = self.tokens.get(token)
        if found is None:
            word = token[1:]
            if self.words_are_whole and token[0] == " " and word.isascii() and word.isalpha():
                return self[word]
            found = self._ids(token.encode("utf-8", "replace").decode("latin-1").translate(self.letters))
            if len(token) <= pieces.LONGEST and len(self.tokens) < pieces.KEPT_TOKENS:
                self.tokens[token] = found
        return found

    def _ids(self, letters: str) -> bytes:
        return b"".join([self.number[t.id] for t in self.model.tokenize(letters)])

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = pieces.cut(text)
        return self._piece(first) + b"".join(map(self.__getitem__, rest))


KEPT.append(Encoder._loaded)


def id_width(size: int) -> int:
    """Bytes of an id in a vocabulary of so many."""
    return 2 if size <= 1 << 16 else 4


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system and path of a URI as Hadoop writes it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = 0, folder: str | None = None
) -> DataFrame:
    """Write the ids of `docs` in ascending order of `key`, and return the index.

    `path` is the tokenizer's file, `end` the id after each document. The index
    has a row per document: its file, where its frame is, its number of ids, and
    how many ids stand before it in its shard. Null texts are empty documents;
    a null id comes last. Repeated rows are written as often as they occur, and
    rows of one id in the order of a hash of their text. An empty table gives an
    empty index. Other columns are not read.
    """
    target = folder or scratch(docs.sparkSession, "tokens")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder.of(path)
        last = np.array([end], encode.type).tobytes()
        shard = TaskContext.get().partitionId()
        store, where = place(target)
        store.create_dir(where, recursive=True)
        name = f"{shard:06d}-{uuid.uuid4().hex}.bin"
        at = before = 0
        with store.open_output_stream(f"{where}/{name}") as out:
            for batch in batches:
                for start in range(0, batch.num_rows, PYTHON_ROWS):
                    part = batch.slice(start, PYTHON_ROWS)
                    offsets, sizes, tokens, befores = [], [], [], []
                    keys = part.column(0).to_pylist()
                    for doc_id, whole in zip(keys, part.column(1).to_pylist(), strict=True):
                        ids = encode(whole or "") + last
                        data = pack(doc_id, ids, encode.width)
                        out.write(data)
                        offsets.append(at)
                        sizes.append(len(data))
                        tokens.append(len(ids) // encode.width)
                        befores.append(before)
                        at += len(data)
                        before += tokens[-1]
                    n = part.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.int64()),
                            pa.array([shard] * n, pa.int32()),
                            pa.array([name] * n),
                            *[pa.array(x, pa.int64()) for x in (offsets, sizes, tokens, befores)],
                        ],
                        names=[c.split()[0] for c in INDEX.split(", ")],
                    )
                batch = part = None
        trim()

    # The hash lets the range sort split the rows of an id that many rows have.
    ordered = docs.select(quoted(key).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text")).orderBy(
        F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
    )
    with short_batches(docs.sparkSession):
        index = saved(ordered.mapInArrow(convert, INDEX), "token-index")
    # One row per shard, as many as tasks.
    shards = index.groupBy("shard").agg(F.sum("tokens").alias("in_shard"))
    earlier = F.sum("in_shard").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    base = shards.select("shard", F.coalesce(earlier, F.lit(0)).alias("base"))
    return index.join(F.broadcast(base), "shard").select(
        "doc_id",
        (F.col("base") + F.col("before")).alias("start"),
        F.concat(F.lit(target + "/"), F.col("file")).alias("file"),
        "offset",
        "bytes",
    )


def read(index: DataFrame, convert: Callable[[int | None, np.ndarray], Sequence], schema: str) -> DataFrame:
    """Read the documents of an index, in its order, and give each to `convert`.

    The result has the columns of `schema`: `convert` gets the document id and
    the ids, as stored, and returns the last of them; the first ones are columns
    of the index. Frames that follow one another are read at once.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    kept = [n for n in names if n in index.columns and n not in ("file", "offset", "bytes")]
    types = [pa.int64()] * len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with OpenFile() as files:
            for batch in batches:
                for start in range(0, batch.num_rows, PYTHON_ROWS):
                    part = batch.slice(start, PYTHON_ROWS)
                    col = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
                    frames = files.frames(list(zip(col["file"], col["offset"], col["bytes"], strict=True)))
                    made = [convert(*unpack(f)) for f in frames]
                    values = [*[col[n] for n in kept], *(map(list, zip(*made, strict=True)))]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)

    return index.mapInArrow(run, schema)


class OpenFile:
    """The file read last stays open."""

    def __enter__(self) -> OpenFile:
        self.name, self.file = None, None
        return self

    def __exit__(self, *_) -> None:
        if self.file:
            self.file.close()

    def frames(self, wanted: list[tuple[str, int, int]]) -> list[bytes]:
        """The bytes at (file, offset, size), in the order asked for."""
        out: list[bytes] = [b""] * len(wanted)
        order = sorted(range(len(wanted)), key=lambda i: wanted[i])
        n = 0
        while n < len(order):
            name, start, size = wanted[order[n]]
            run, stop = [order[n]], start + size
            while n + len(run) < len(order) and wanted[order[n + len(run)]][:2] == (name, stop):
                run.append(order[n + len(run)])
                stop += wanted[run[-1]][2]
            data = self._open(name).read_at(stop - start, start)
            for i in run:
                out[i] = data[wanted[i][1] - start : wanted[i][1] - start + wanted[i][2]]
            n += len(run)
        return out

    def _open(self, name: str) -> pa.NativeFile:
        if name != self.name:
            if self.file:
                self.file.close()
            store, where = place(name)
            self.name, self.file = name, store.open_input_file(where)
        return self.file
