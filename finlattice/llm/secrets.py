"""Secret scans with a recursive decoding worklist.

Each whole text is scanned for secrets of three kinds. It is also unwrapped: URL escapes, Unicode escapes, base64 runs
and compressed data are decoded to further layers, which are scanned and unwrapped in turn until nothing new
appears. A layer remembers which span of the original text each of its characters came from, so every
finding maps to code points of the original. A layer that was seen before with the same origin (a cycle)
isn't queued again.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

KINDS = ("assign", "access", "hex")
# Fixed patterns of the scan.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

_HEX_RUN = re.compile(r"[0-9a-f]{24,}")
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|((?:\\x[0-9A-Fa-f]{2})+)|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 over several lines; its last line may be short.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[A-Za-z0-9+/_-]{16,}+)*\r?\n[A-Za-z0-9+/_-]+={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
#: In bytes decoded from base64 of unknown start: text that may hold a finding (12 characters at least, of one byte or of two), and beginnings of compressed data.
_STRETCH = re.compile(rb"[\t\n\r\x20-\x7e]{12,}|(?:[\t\n\r\x20-\x7e]\0){12,}|(?:\0[\t\n\r\x20-\x7e]){12,}")
#: ASCII in two bytes.
_WIDE = re.compile(r"(?:[\t\n\r\x20-\x7e]\0){12,}|(?:\0[\t\n\r\x20-\x7e]){12,}")
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|x[\x01\x5e\x9c\xda]")
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
#: What may hold a finding or a layer; other texts (RE2 tells them apart a batch at a time) need no scan.
_ANY = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{16}"
#: Layers of escapes below escapes that are opened one by one; deeper nests are undone at once: what only a layer between shows (a secret that the next escape cuts up) isn't found there.
MAX_STEPS = 6
#: An escape that ends with the text so far.
_ESCAPE_END = re.compile(r"%[0-9A-Fa-f]{2}\Z|\\u[0-9A-Fa-f]{4}\Z|\\u\{[0-9A-Fa-f]{1,6}\}\Z|\\U[0-9A-Fa-f]{8}\Z|\\x[0-9A-Fa-f]{2}\Z|&#[xX][0-9A-Fa-f]{1,6};\Z|&#[0-9]{1,7};\Z")
_LONGEST_ESCAPE = 12
#: Bytes of one decompressed layer; larger ones are counted, and read in windows of this size, a quarter of which they share.
MAX_LAYER = 64 << 20


def scan(text: str) -> list[tuple[str, int, int]]:
    """Base findings of one layer: (kind, start, end), leftmost and non-overlapping for each kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return out + [("hex", m.start(), m.end()) for m in _HEX_RUN.finditer(text)]


class Layer:
    """A text with the original span of each of its characters (None: it is the original)."""

    __slots__ = ("text", "start", "end", "steps")

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None, steps: int = 0) -> None:
        self.text, self.start, self.end = text, start, end
        #: Escapes undone one below the other to get here.
        self.steps = steps

    def origin(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (int(self.start[a]), int(self.end[b - 1]))


def _joined(layer: Layer, pieces: list[tuple[int, int, str]]) -> Layer:
    """The layer with the spans of ``pieces`` replaced; each new character comes from the whole piece's span."""
    n = len(layer.text)
    start = np.arange(n) if layer.start is None else layer.start
    end = np.arange(1, n + 1) if layer.end is None else layer.end
    texts, starts, ends, at = [], [], [], 0
    for a, b, new in pieces:
        texts += [layer.text[at:a], new]
        starts += [start[at:a], np.full(len(new), start[a])]
        ends += [end[at:a], np.full(len(new), end[b - 1])]
        at = b
    texts.append(layer.text[at:])
    return Layer("".join(texts), np.concatenate((*starts, start[at:])), np.concatenate((*ends, end[at:])), layer.steps + 1)


def settled(layer: Layer) -> Layer:
    """The layer with all escapes undone, also those that only undoing others brings about, in one pass from left to right.

    A decoded character joins the text so far, where it may complete an escape again; each step shortens the text, so the pass
    takes time in proportion to it. Bytes above 127 of URL and hex escapes are read as UTF-8 where they make characters.
    """
    n = len(layer.text)
    start = np.arange(n) if layer.start is None else layer.start
    end = np.arange(1, n + 1) if layer.end is None else layer.end
    chars: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    raw: list[bool] = []  # whether a character is a decoded byte above 127
    for c, a, b in zip(layer.text, start.tolist(), end.tolist(), strict=True):
        byte = False
        while True:
            chars.append(c)
            starts.append(a)
            ends.append(b)
            raw.append(byte)
            if not (c in _HEX_DIGITS or c in "};"):
                break
            m = _ESCAPE_END.search("".join(chars[-_LONGEST_ESCAPE:]))
            if m is None:
                break
            if m[0][0] == "&" and m[0][2] not in "xX":
                value = int(m[0][2:-1])
            else:
                value = int(m[0].strip("%\\uUxX{}&#;"), 16)
            if (c_ := _code_point(value)) is None:
                break
            length = len(m[0])
            byte = value > 127 and (m[0][0] == "%" or m[0][:2] == "\\x")
            c, a = c_, starts[-length]
            del chars[-length:], starts[-length:], ends[-length:], raw[-length:]
    out = Layer("".join(chars), np.array(starts, np.int64), np.array(ends, np.int64), MAX_STEPS)
    pieces, at = [], 0
    while at < len(raw):
        if raw[at]:
            to = at
            while to < len(raw) and raw[to]:
                to += 1
            try:
                text, place = out.text[at:to].encode("latin-1").decode(), at
                for x in text:
                    size = len(x.encode())
                    pieces.append((place, place + size, x))
                    place += size
            except UnicodeDecodeError:
                pass
            at = to
        at += 1
    return _joined(out, pieces) if pieces else out


def _readable(data: bytes) -> str | None:
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    odd = sum(1 for c in text if not c.isprintable() and c not in "\t\n\r")
    return text if text and odd * 20 <= len(text) else None


def _inflated(data: bytes, size: int, left: list[int] | None = None) -> Iterator[bytes]:
    """Compressed data (by its magic: gzip, zlib, bzip2, xz), opened in chunks of ``size`` bytes at most, member by member.

    ``left`` gets the number of bytes after each member.
    """
    rest = data
    try:
        while rest:
            if rest[:2] == b"\x1f\x8b" or (len(rest) > 2 and rest[0] == 0x78 and (rest[0] * 256 + rest[1]) % 31 == 0):
                d = zlib.decompressobj(wbits=47)
            elif rest[:3] == b"BZh":
                d = bz2.BZ2Decompressor()
            elif rest[:6] == b"\xfd7zXZ\x00":
                d = lzma.LZMADecompressor()
            else:
                return
            while not d.eof:
                out = d.decompress(rest, size)
                rest = getattr(d, "unconsumed_tail", b"")
                if out:
                    yield out
                elif not rest and getattr(d, "needs_input", True):  # it ends early
                    return
            if left is not None:
                left.append(len(d.unused_data))
            rest = d.unused_data.lstrip(b"\0")
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return


def inflate(data: bytes | memoryview) -> tuple[bytes | None, bool, int, bool]:
    """Compressed data opened, all members of it, whether it is too large for one layer, the bytes it takes, and whether a member came to its checked end."""
    out, n, left = [], 0, []
    for chunk in _inflated(data, MAX_LAYER + 1, left):
        out.append(chunk)
        n += len(chunk)
        if n > MAX_LAYER:
            return None, True, len(data), bool(left)
    used = len(data) - left[-1] if left else len(data)
    return b"".join(out) if out else None, False, used, bool(left)


def _bytes_pieces(data: bytes, a: int, width: int) -> list[tuple[int, int, str]]:
    """Escaped bytes as pieces, one for each character they make; a byte that isn't UTF-8 is a character of its own."""
    out, at = [], a
    for c in data.decode(errors="surrogateescape"):
        lone = "\udc80" <= c <= "\udcff"
        n = width if lone else width * len(c.encode())
        out.append((at, at + n, chr(ord(c) - 0xDC00) if lone else c))
        at += n
    return out


def _spread(text: str, s: int, e: int) -> Layer:
    # one number seen at every place: a large layer costs no arrays
    return Layer(text, np.broadcast_to(np.int64(s), len(text)), np.broadcast_to(np.int64(e), len(text)))


def _windows(data: bytes, s: int, e: int) -> Iterator[Layer]:
    """A large layer in windows that overlap; as all of it has one origin, a finding cut by a window's end stays the same one."""
    text, decode = "", codecs.getincrementaldecoder("utf-8")("replace").decode
    for chunk in _inflated(data, MAX_LAYER - MAX_LAYER // 4):
        text = text[-(MAX_LAYER // 4) :] + decode(chunk)
        yield _spread(text, s, e)


class _Opened:
    def __init__(self) -> None:
        self.layers: list[Layer] = []
        self.streams: list[Iterator[Layer]] = []
        self.too_large = 0

    def blob(self, layer: Layer, a: int, b: int, data: bytes | memoryview, end: Callable[[int], int] | None = None, sure: bool = True) -> bool:
        """Opens decoded bytes of the span a:b that are text or compressed; ``end`` tells b by the bytes that are used of compressed data.

        Compressed data may hold anything, compressed data too: whatever is below is opened until nothing is compressed. ``sure``: the data's beginning is known;
        else compressed data must come to its checked end, or be text, to be no chance likeness.
        """
        raw, large, used, ended = inflate(data)
        if end:
            b = end(used)
        span = layer.origin(a, b)
        if large:
            self._large(data, *span)
            return True
        if raw is not None:
            if not (sure or ended or _readable(raw)):
                return False
            self._inside(raw, *span)
            return True
        text = None if end else _readable(data)
        if text is None:
            return False
        self.layers.append(_spread(text, *span))
        return True

    def _large(self, data: bytes | memoryview, s: int, e: int) -> None:
        self.too_large += 1
        self.streams.append(_windows(data, s, e))

    def _inside(self, data: bytes, s: int, e: int) -> None:
        """The layers of decompressed bytes, all of one origin: as text whatever they are, and what compressed data in them holds."""
        seen, stack = set(), [data]
        while stack:
            data = stack.pop()
            if (mark := hashlib.sha256(data).digest()) in seen:
                continue
            seen.add(mark)
            try:
                self._text(data.decode(), s, e)
                if not data.startswith(b"BZh"):  # of all magics, the only one that is UTF-8
                    continue
            except UnicodeDecodeError:
                pass
            view, after, whole = memoryview(data), 0, False
            for m in _MAGIC.finditer(data):
                if m.start() < after:
                    continue
                raw, large, used, ended = inflate(view[m.start() :])
                if large:
                    self._large(view[m.start() :], s, e)
                elif raw is not None and (ended or m.start() == 0 or _readable(raw)):
                    stack.append(raw)
                    if ended:
                        after = m.start() + used
                        whole = m.start() == 0 and after == len(data)
            if not whole:
                self._text(data.decode("latin-1"), s, e)

    def _text(self, text: str, s: int, e: int) -> None:
        self.layers.append(_spread(text, s, e))
        if "\0" in text:
            self.layers += [_spread(m[0].replace("\0", ""), s, e) for m in _WIDE.finditer(text)]

    def parts(self, layer: Layer, at: np.ndarray, body: str, whole: bool) -> None:
        """Opens what any of the four alignments of a base64 run holds; ``at``: the places of its characters.

        A run may begin with other characters (a path, a prefix, a word of the line before). ``whole``: alignment 0 is done.
        """
        for off in range(whole, min(4, len(body) - 15)):
            run = body[off:]
            run = run[: len(run) - (len(run) % 4 == 1)]
            data = base64.b64decode(run + "=" * (-len(run) % 4))
            view = memoryview(data)  # a slice copies nothing
            for m in _STRETCH.finditer(data):
                a, b = off + m.start() // 3 * 4, min(off + -(-m.end() // 3) * 4, len(body))
                self.layers.append(_spread(m[0].replace(b"\0", b"").decode(), *layer.origin(int(at[a]), int(at[b - 1]) + 1)))
            for m in _MAGIC.finditer(data):

                def end(used: int, off: int = off, first: int = m.start()) -> int:
                    return int(at[min(off + -(-(first + used) // 3) * 4, len(body)) - 1]) + 1

                self.blob(layer, int(at[off + m.start() // 3 * 4]), 0, view[m.start() :], end, False)

    def escaped(self, layer: Layer, a: int, width: int, data: bytes) -> list[tuple[int, int, str]]:
        """Pieces for a run of escaped bytes; compressed data in it is opened."""
        after = 0
        for m in _MAGIC.finditer(data):
            first, took = m.start(), []

            def end(used: int, first: int = first, took: list[int] = took) -> int:
                took.append(first + used)
                return a + width * (first + used)

            if first >= after and self.blob(layer, a + width * first, 0, data[first:], end, first == 0):
                after = took[0]
        return _bytes_pieces(data, a, width)


def _code_point(value: int) -> str | None:
    return chr(value) if value < 0x110000 and not 0xD800 <= value < 0xE000 else None


def unwrap(layer: Layer) -> _Opened:
    """The layers directly below one layer."""
    out, text = _Opened(), layer.text
    if layer.steps == MAX_STEPS and ("%" in text or "\\" in text or "&#" in text):
        out.layers.append(settled(layer))
        out.layers[-1].steps += 1
    if "%" in text and layer.steps < MAX_STEPS:
        pieces = []
        for m in _URL.finditer(text):
            pieces += out.escaped(layer, m.start(), 3, bytes.fromhex(m[0].replace("%", "")))
        if pieces:
            out.layers.append(_joined(layer, pieces))
    if ("\\" in text or "&#" in text) and layer.steps < MAX_STEPS:
        pieces, high = [], None
        for m in _UNICODE.finditer(text):
            if m[4]:
                pieces += out.escaped(layer, m.start(), 4, bytes.fromhex(m[4].replace("\\x", "")))
                continue
            value = int(m[1] or m[2] or m[3] or m[5] or "0", 16) or int(m[6] or 0)
            if m[2] and 0xD800 <= value < 0xDC00:
                high = (m.start(), m.end(), value)
                continue
            if m[2] and 0xDC00 <= value < 0xE000 and high and high[1] == m.start():
                pieces.append((high[0], m.end(), chr(0x10000 + ((high[2] - 0xD800) << 10) + value - 0xDC00)))
            elif (c := _code_point(value)) is not None:
                pieces.append((m.start(), m.end(), c))
            high = None
        if pieces:
            out.layers.append(_joined(layer, pieces))
    for m in _BASE64.finditer(text):
        body = m[0].rstrip("=").replace("-", "+").replace("_", "/")
        full = body[:-1] if len(body) % 4 == 1 else body
        try:
            data = base64.b64decode(full + "=" * (-len(full) % 4))
        except (binascii.Error, ValueError):
            continue
        whole = out.blob(layer, m.start(), m.end(), data)
        out.parts(layer, np.arange(m.start(), m.end()), body, whole)
    for m in _WRAPPED.finditer(text):
        lines = list(_LINE.finditer(m[0]))
        at = m.start() + np.concatenate([np.arange(x.start(), x.end()) for x in lines])
        out.parts(layer, at, "".join(x[0] for x in lines).replace("-", "+").replace("_", "/"), False)
    return out


def find_secrets(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int, int]:
    """Base findings, all findings (mapped to the text), layers opened, and layers too large to open."""
    base = scan(text)
    found, seen, queue, opened, large = dict.fromkeys(base), set(), deque([Layer(text)]), 0, 0
    streams: list[Iterator[Layer]] = []
    while queue or streams:
        if queue:
            below = unwrap(queue.popleft())
            large += below.too_large
            streams += below.streams
            layers = below.layers
        elif (window := next(streams[-1], None)) is not None:  # one window at a time is in memory
            layers = [window]
        else:
            streams.pop()
            continue
        for layer in layers:
            ends = (int(layer.start[0]), int(layer.end[-1])) if len(layer.text) else (0, 0)
            mark = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), *ends)
            if mark in seen or layer.text == text:
                continue
            seen.add(mark)
            opened += 1
            for kind, a, b in scan(layer.text):
                found.setdefault((kind, *layer.origin(a, b)))
            queue.append(layer)
    return base, list(found), opened, large


def spans_text(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_too_large long"
_NOTHING = hashlib.sha256(b"").hexdigest()


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        n = b.num_rows
        counts, sha, spans = np.zeros((5, n), np.int64), [_NOTHING] * n, [""] * n
        may = pc.fill_null(pc.match_substring_regex(b.column(1), _ANY), False)
        at = np.flatnonzero(may.to_numpy(zero_copy_only=False))
        for i, text in zip(at.tolist(), b.column(1).take(pa.array(at)).to_pylist(), strict=True):
            base, found, opened, large = find_secrets(text)
            if base:
                sha[i] = hashlib.sha256(spans_text(base).encode()).hexdigest()
            spans[i] = spans_text(found)
            counts[:, i] = [*(sum(k == kind for k, _, _ in base) for kind in KINDS), opened, large]
        yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, counts[:3]), pa.array(sha), pa.array(spans), *map(pa.array, counts[3:])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_too_large"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): counts and digest of the base findings, and all spans.

    Null and empty texts have no findings: zero counts, an empty ``spans`` and the digest of nothing. Spans
    that several layers report are given once. ``n_layers`` counts decoded layers.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan_batches, _SCHEMA)


def _mask_batches(batches: Iterator[pa.RecordBatch], mark: str) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        at = b.schema.get_field_index("text")
        texts = b.column(at).to_pylist()
        may = pc.fill_null(pc.match_substring_regex(b.column(at), _ANY), False).to_pylist()
        for i, (text, m) in enumerate(zip(texts, may, strict=True)):
            if m and (found := find_secrets(text)[1]):
                parts, end = [], 0
                for a, z in sorted((a, z) for _, a, z in found):
                    if a >= end:
                        parts += [text[end:a], mark]
                    end = max(end, z)
                texts[i] = "".join((*parts, text[end:]))
        yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))


def mask_secrets(docs: DataFrame, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with every found span of ``text`` (overlapping ones as one) replaced by ``mark``; other columns are kept."""
    return docs.mapInArrow(lambda batches: _mask_batches(batches, mark), docs.schema)
