"""Secrets in plain and in nested encodings.

A worklist of layers starts with the text itself. Each layer is scanned and then
unwrapped: URL escapes, Unicode escapes and character references are replaced in
place, base64 runs and compressed data become layers of their own. Every
character of a layer knows the stretch of the original text it comes from, so a
secret found five layers deep is reported where its wrapping stands. A layer
whose content was met before is not unwrapped again, which ends cycles; the work
ends when no layer is new.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from varigrove.llm.common import in_slices, joined_spans, quoted

KINDS = ("assign", "access", "hex")

#: Fixed patterns of the contract.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 24 or more begin where a run begins, so shorter ones need not be looked at.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

_ESCAPES = re.compile(
    r"(?P<url>(?:%[0-9A-Fa-f]{2})+)|(?P<unicode>(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2})+)"
    r"|(?P<reference>&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|amp|lt|gt|quot|apos);)"
)
_ESCAPED = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
# A run goes on over line ends (with blanks that indent the next line), so wrapped lines are one run.
# Line ends may be written out, as in JSON; a short line counts if another one follows.
_END = r"(?:\r?\n[\x20\t]*|(?:\\r)?\\n)"
_BASE64 = re.compile(
    rf"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{{16,}}|[A-Za-z0-9+/_-]{{4,15}}(?={_END}[A-Za-z0-9+/_-]{{4}}))(?:{_END}[A-Za-z0-9+/_-]+)*={{0,2}}"
)
_LINE_END = re.compile(_END)
_SEPARATOR = re.compile(r"[+/_-]")
_LINE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: The fewest digits that a run of base64 has over all its lines.
LEAST_RUN = 16
# Bytes written out in a text: in a word that holds URL escapes, or in a line that holds other ones.
_URL_BYTES = re.compile(r"(?<![\x21-\x7E])[\x21-\x7E]*%[0-9A-Fa-f]{2}[\x21-\x7E]*")
_LINE_BYTES = re.compile(r"(?<![\x20-\x7E\t])[\x20-\x7E\t]*\\(?:x|u00)[0-9A-Fa-f]{2}[\x20-\x7E\t]*")
_UNIT = re.compile(rb"\\(?:x|u00)([0-9A-Fa-f]{2})|\\([abfnrtv0\\'\"/])")
_NAMED = dict(zip(b"abfnrtv0", b"\a\b\f\n\r\t\v\0"))
_PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\(\xb5/\xfd|\x78[\x01\x5e\x9c\xda]")
_MAGIC = ((b"\x1f\x8b", "gzip"), (b"BZh", "bz2"), (b"\xfd7zXZ\x00", "xz"), (b"(\xb5/\xfd", "zstd"))

#: Decompressed data is read in stretches of this size; a layer of it overlaps the last
#: by OVERLAP at least, and by the whole of an encoded run or secret that its end cuts.
STRETCH = 1 << 20
OVERLAP = 1 << 12
#: Bytes that an encoded run or a secret is made of; line ends are in wrapped base64.
_RUN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.%\\{}&#;:\"'\r\n-"


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end of the secrets that stand openly in a text."""
    if "=" in text or ":" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


class Layer:
    """A text, and where in the original each of its characters begins and ends: arrays, or one pair for all."""

    def __init__(self, text: str, begin: np.ndarray | int, end: np.ndarray | int):
        self.text, self.begin, self.end = text, begin, end

    @classmethod
    def whole(cls, text: str) -> Layer:
        at = np.arange(len(text), dtype=np.int64)
        return cls(text, at, at + 1)

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if isinstance(self.begin, int):
            return self.begin, self.end
        return int(self.begin[start:end].min()), int(self.end[start:end].max())

    def layers(self) -> Iterator[Layer]:
        """The layers right below, made as they are taken."""
        if (plain := self.replaced()) is not None:
            yield plain
        yield from self.inside()

    def replaced(self) -> Layer | None:
        """The layer with its escapes replaced, or None if it has none."""
        one = isinstance(self.begin, int)
        parts, begins, ends, at = [], [], [], 0
        for m in _ESCAPES.finditer(self.text):
            plain = _plain(m)
            if plain == m[0]:
                continue
            parts += [self.text[at : m.start()], plain]
            if not one:
                start, stop = self.origin(m.start(), m.end())
                begins += [self.begin[at : m.start()], np.full(len(plain), start)]
                ends += [self.end[at : m.start()], np.full(len(plain), stop)]
            at = m.end()
        if not at:
            return None
        text = "".join([*parts, self.text[at:]])
        if one:
            return Layer(text, self.begin, self.end)
        return Layer(text, np.concatenate([*begins, self.begin[at:]]), np.concatenate([*ends, self.end[at:]]))

    def inside(self) -> Iterator[Layer]:
        """Layers of what the base64 runs decode to: of each line, and of the lines that one run may be wrapped in."""
        for m in _BASE64.finditer(self.text):
            runs = [(m.start(), m.end())]
            if "\n" in m[0]:
                runs += [(m.start() + x.start(), m.start() + x.end()) for x in _LINE.finditer(m[0])]
            for start, end in runs:
                origin = self.origin(start, end)
                run = _LINE_END.sub("", self.text[start:end])
                for text in _run_texts(run) if len(run) >= LEAST_RUN else ():
                    yield Layer(text, *origin)
        for mark, run, unescaped in (("%", _URL_BYTES, unquote_to_bytes), ("\\", _LINE_BYTES, _unescaped)):
            for m in run.finditer(self.text) if mark in self.text else ():
                data = unescaped(m[0])
                for at in _PACKED.finditer(data):
                    for text in _decompressed(data, at.start()):
                        yield Layer(text, *self.origin(m.start(), m.end()))


def _unescaped(text: str) -> bytes:
    """Bytes of a line in which some are written as escapes."""
    return _UNIT.sub(lambda m: bytes([int(m[1], 16) if m[1] else _NAMED.get(m[2][0], m[2][0])]), text.encode("ascii"))


def _plain(m: re.Match[str]) -> str:
    if m.lastgroup == "url":
        return unquote_to_bytes(m[0]).decode("utf-8", "replace")
    if m.lastgroup == "reference":
        return html.unescape(m[0])
    units = [int(next(filter(None, g)), 16) for g in _ESCAPED.findall(m[0])]
    if any(u > 0x10FFFF for u in units):
        return m[0]
    # Surrogates come in pairs.
    return "".join(map(chr, units)).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def unbase64(run: str) -> bytes:
    """Bytes of a run; a last digit that can't stand alone is left out."""
    bare = run.rstrip("=").replace("-", "+").replace("_", "/")
    bare = bare[: len(bare) - (len(bare) % 4 == 1)]
    return base64.b64decode(bare + "=" * (-len(bare) % 4))


def _run_texts(run: str) -> Iterator[str]:
    """Texts that a run holds from any of its characters on: four alignments, and packed data behind a separator."""
    bare = run.rstrip("=")
    aligned = [unbase64(bare[k:]) for k in range(4)]
    for data in aligned:
        yield from texts_of(data)
    for m in _SEPARATOR.finditer(bare):
        offset = m.end() // 4 * 3
        data = aligned[m.end() % 4]
        if offset and _kind(data[offset : offset + 8]):
            yield from _decompressed(data[offset:])


def _kind(data: bytes) -> str | None:
    """How packed data begins; any zlib header counts, so a text may look like one."""
    if len(data) > 1 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0:
        return "zlib"
    return next((k for magic, k in _MAGIC if data.startswith(magic)), None)


def texts_of(data: bytes) -> Iterator[str]:
    """`data` as a text, without its NULs too (UTF-16), and the stretches of what it decompresses to."""
    yield data.decode("utf-8", "replace")
    if b"\0" in data:
        yield data.replace(b"\0", b"").decode("utf-8", "replace")
    yield from _decompressed(data)


def _decompressed(data: bytes, start: int = 0) -> Iterator[str]:
    """Texts of what `data` decompresses to. A run of _RUN that a stretch ends in is carried over whole."""
    held: list[bytes] = []
    for chunk in _members(data, start):
        run = _run_start(chunk)
        if run == 0:
            held.append(chunk)
            continue
        head = b"".join([*held, chunk[:run]])
        yield head.decode("utf-8", "replace")
        held = [head[-OVERLAP:], chunk[run:]]
    if held:
        yield b"".join(held).decode("utf-8", "replace")


def _run_start(chunk: bytes) -> int:
    """Where the run begins that `chunk` ends in; blanks that indent a line belong to it."""
    at = len(chunk)
    while True:
        at = len(chunk[:at].rstrip(_RUN))
        line = len(chunk[:at].rstrip(b" \t"))
        if line == at or (line and chunk[line - 1 : line] != b"\n"):
            return at
        at = line


#: What unpacking may raise on damaged data.
_DAMAGE = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError, IndexError, MemoryError)
#: Bytes of packed data that are fed at once.
FEED = 1 << 12
#: Memory for the dictionary of xz data; of data that ask for more, as many bytes are read.
XZ_MEMORY = 1 << 28


def _body(kind: str, data: bytes, at: int) -> int:
    """Where the deflated bytes begin behind a gzip or zlib header."""
    if kind == "zlib":
        return at + 2
    if kind != "gzip":
        return at
    flags, body = data[at + 3], at + 10
    if flags & 4:
        body += 2 + int.from_bytes(data[body : body + 2], "little")
    for flag in (8, 16):
        if flags & flag:
            body = data.index(b"\0", body) + 1
    return body + 2 * (flags >> 1 & 1)


class _Member:
    """One member of packed data, read from the front; checksums of gzip and zlib are not asked for."""

    #: Bytes of the checksums behind what was deflated.
    TRAILER = {"gzip": 8, "zlib": 4}

    def __init__(self, kind: str, data: bytes, at: int):
        self.kind, self.data, self.at, self.open = kind, data, _body(kind, data, at), None
        if kind == "zstd":
            self.machine = zstandard.ZstdDecompressor().stream_reader(memoryview(data)[at:], read_across_frames=True)
        elif kind == "bz2":
            self.machine = bz2.BZ2Decompressor()
        elif kind == "xz":
            self.machine = lzma.LZMADecompressor(memlimit=XZ_MEMORY)
            try:
                self.machine.decompress(data[at : at + FEED], 1)
                self.machine = lzma.LZMADecompressor()
            except lzma.LZMAError:
                self.machine, self.open = lzma.LZMADecompressor(), XZ_MEMORY
        else:
            self.machine = zlib.decompressobj(-15)

    def read(self, most: int) -> bytes:
        """The next bytes; none at the end of the member or of the data."""
        if self.kind == "zstd":
            return self.machine.read(most)
        if self.open is not None:
            most = min(most, self.open)
        while most and not self.machine.eof:
            fed = self.data[self.at : self.at + FEED]
            if self.kind in ("gzip", "zlib", "deflate"):
                chunk = self.machine.decompress(fed, most)
                self.at += len(fed) - len(self.machine.unconsumed_tail)
            else:
                fed = fed if self.machine.needs_input else b""
                chunk = self.machine.decompress(fed, most)
                self.at += len(fed)
            if chunk:
                self.open = None if self.open is None else self.open - len(chunk)
                return chunk
            if self.at >= len(self.data) and not fed:
                break
        return b""

    def end(self) -> int | None:
        """Where the member ends; None if it does not, or if frames behind it were read with it."""
        if self.kind == "zstd" or not self.machine.eof:
            return None
        return self.at - len(self.machine.unused_data) + self.TRAILER.get(self.kind, 0)


def _stretches(kind: str, data: bytes, at: int) -> Iterator[bytes | int | None]:
    """Stretches of a member, up to its damage if it is damaged, and then where it ends."""
    given = 0
    try:
        member = _Member(kind, data, at)
        while chunk := member.read(STRETCH):
            given += len(chunk)
            yield chunk
        yield member.end()
        return
    except _DAMAGE:
        pass
    # What was unpacked in the call that failed is lost with it: get there again, in single bytes.
    last = bytearray()
    try:
        member = _Member(kind, data, at)
        while given and (chunk := member.read(min(given, STRETCH))):
            given -= len(chunk)
        while byte := member.read(1):
            last += byte
    except _DAMAGE:
        pass
    if last:
        yield bytes(last)
    yield None


def _deflated(data: bytes, at: int) -> bool:
    """Whether data are deflated without a header: they unpack to their own end."""
    try:
        member, size = _Member("deflate", data, at), 0
        while chunk := member.read(STRETCH):
            size += len(chunk)
        return size >= 8 and member.end() is not None
    except _DAMAGE:
        return False


def _members(data: bytes, at: int = 0) -> Iterator[bytes]:
    """Stretches of all members one behind the other from `at` on, and what stands behind the last."""
    first = True
    while kind := _kind(data[at : at + 8]):
        end = None
        for chunk in _stretches(kind, data, at):
            if isinstance(chunk, bytes):
                yield chunk
            else:
                end = chunk
        if end is None:
            break
        at, first = end, False
        while data[at : at + 1] == b"\0":
            at += 1
    if first and _deflated(data, at):
        yield from (x for x in _stretches("deflate", data, at) if isinstance(x, bytes))
    if not first and at < len(data):
        yield data[at:]


def find_secrets(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Open secrets of a text, and those of its inner layers that no open one of their kind covers."""
    base = list(scan(text))
    added: set[tuple[str, int, int]] = set()
    todo = [Layer.whole(text).layers()] if _may_wrap(text) else []
    own = _digest(text)
    seen: set[tuple[bytes, int, int]] = set()
    while todo:
        inner = next(todo[-1], None)
        if inner is None:
            todo.pop()
            continue
        digest = _digest(inner.text)
        if not inner.text or digest == own or (key := (digest, *inner.origin(0, 1))) in seen:
            continue
        seen.add(key)
        added |= {(kind, *inner.origin(s, e)) for kind, s, e in scan(inner.text)}
        if _may_wrap(inner.text):
            todo.append(inner.layers())
    new = [x for x in added if not any(k == x[0] and s <= x[1] and x[2] <= e for k, s, e in base)]
    return base, sorted(new)


def _may_wrap(text: str) -> bool:
    return _ESCAPES.search(text) is not None or _BASE64.search(text) is not None


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans, layered.

    The counts and the digest are of secrets that stand openly in the text; they
    are written kind:start:end, by start and then kind, comma-joined, in code
    points. `spans` has those and the ones found in inner layers, `layered` the
    number of the latter. Damaged packed data count up to the damage. Very long
    texts are scanned whole, one at a time. Null and empty texts have none. Repeated rows, ties and
    null ids are answered row by row; other columns are not read.
    """
    rank = {k: n for n, k in enumerate(KINDS)}

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans, layered = [], [], [], []
        for whole in batch.column(1).to_pylist():
            base, added = find_secrets(whole or "")
            ordered = lambda found: joined_spans([(s, k, rank[k], e) for k, s, e in found])
            counts.append([sum(k == kind for k, _, _ in base) for kind in KINDS])
            digests.append(hashlib.sha256(ordered(base).encode()).hexdigest())
            spans.append(ordered(base + added))
            layered.append(len(added))
        columns = [pa.array([c[n] for c in counts], pa.int64()) for n in range(len(KINDS))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(layered, pa.int64())],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "layered"],
        )

    rows = docs.select(quoted(key).alias("doc_id"), quoted(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        in_slices(convert), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, layered long"
    )
