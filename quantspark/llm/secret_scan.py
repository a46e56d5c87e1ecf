"""Secret scanning with a recursive decoding worklist.

Each whole text is scanned, then unwrapped: percent escapes, Unicode, string
and character-reference escapes, UTF-16 text, base64 runs (plain, URL-safe,
wrapped over lines, after other letters) and compressed data (gzip, zlib, bzip2,
xz, written in base64 or in escapes; raw deflate at the start of a base64 run)
open new layers that are scanned and unwrapped in turn until nothing new
appears.  All patterns and encodings are ASCII, so decoded bytes are read one
character a byte, and bytes that are no text do not hide the rest.  A layer
keeps, for each of its characters, the span of the original text it came from,
so a finding at any depth maps back to code point offsets of the document.
Layers already seen are skipped, which also breaks cycles.  Layers are opened
depth first, and compressed data of any size is read in windows, so memory
holds one window a level.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.llm import textvec as tv

# The kinds in their listed order and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_VALUE_LENGTH = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")          # a whole run of 20 or more characters
HEX = re.compile(r"[0-9a-f]{24,}")                 # a whole run of 24 or more characters

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}"
                     r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|\\[abfnrtv0'\"\\]|&[A-Za-z][A-Za-z0-9]{1,31};)+")
_ESCAPE_ONE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})"
                         r"|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);|\\([abfnrtv0'\"\\])|(&[A-Za-z][A-Za-z0-9]+;)")
_CONTROL = dict(zip("abfnrtv0", "\a\b\f\n\r\t\v\0"))
_WIDE = re.compile("(?:[\t\n\r\x20-\x7e]\0){6,}|(?:\0[\t\n\r\x20-\x7e]){6,}")      # ASCII in UTF-16
_BREAK = re.compile(r"[ \t]*(?:\r?\n|\\r\\n|\\n)[ \t]*")        # between the lines of a run, also as written in JSON
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{12,}+(?:B[A-Za-z0-9+/_-]++)*+"
                     r"|[A-Za-z0-9+/_-]{2,}+(?:B[A-Za-z0-9+/_-]++)++)={0,2}".replace("B", _BREAK.pattern))
SHORTEST = 12                  # characters of the shortest secret
_WORDLIKE = re.compile(r"[A-Za-z]+|[0-9a-f]+|[0-9]+")
_READABLE = re.compile(rb"[\t\n\r\x20-\x7e]{%d}|(?:[\t\n\r\x20-\x7e]\0){%d}|(?:\0[\t\n\r\x20-\x7e]){%d}" % (
    (SHORTEST,) * 3))
_MAGIC_PATTERN = r"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00"
_ANY_MAGIC = re.compile(_MAGIC_PATTERN.encode())
_ANY_MAGIC_TEXT = re.compile(_MAGIC_PATTERN)
_BYTES = re.compile("[\0-\xff]+")
# First byte of a compressed format and its reader.
_OPENERS = {0x1f: lambda: zlib.decompressobj(31), 0x78: zlib.decompressobj, 0x42: bz2.BZ2Decompressor,
            0xfd: lzma.LZMADecompressor}
MAX_LAYER_BYTES = 64 << 20     # unfolded bytes held at a time; longer data comes in windows of this size
OVERLAP = 1 << 20              # bytes that a window shares with the next
PIECE = 1 << 20


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns: leftmost, non-overlapping per kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= ASSIGN_VALUE_LENGTH]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


class _Stream:
    """The unfolded pieces of the compressed stream that ``data`` starts with.

    Read to the end, ``length`` tells its compressed bytes and ``whole`` whether it ended as its format says; of a
    cut or damaged stream, what unfolds comes out."""

    def __init__(self, data, opener):
        self.data, self.opener, self.length, self.whole = data, opener, 0, False

    def __iter__(self):
        tool, at, out = self.opener(), 0, b""
        try:
            while not tool.eof:
                piece = getattr(tool, "unconsumed_tail", b"")
                if not piece and len(out) < PIECE and getattr(tool, "needs_input", True):
                    piece = bytes(self.data[at:at + (1 << 16)])
                    at += len(piece)
                    if not piece:
                        break
                out = tool.decompress(piece, PIECE)
                if out:
                    yield out
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            pass
        self.whole = tool.eof
        self.length = at - len(tool.unused_data) if tool.eof else at


def _members(data: bytes) -> list[list]:
    """[start, end, streams, whole] of the compressed texts in ``data``; streams that follow each other are one."""
    view, found, done = memoryview(data), [], 0
    for m in _ANY_MAGIC.finditer(data):
        if m.start() < done:
            continue
        opener = _OPENERS[data[m.start()]]
        stream = _Stream(view[m.start():], opener)
        size = sum(map(len, stream))
        if not (size or stream.whole):
            continue
        end = m.start() + stream.length
        if stream.whole:
            done = end
        if found and found[-1][3] and not bytes(view[found[-1][1]:m.start()]).strip(b"\0"):   # padding between members
            found[-1][1:] = end, [*found[-1][2], (m.start(), opener)], stream.whole
        else:
            found.append([m.start(), end, [(m.start(), opener)], stream.whole])
    return found


def _windows(data: bytes, streams):
    """The unfolded bytes of streams as windows of about ``MAX_LAYER_BYTES`` that overlap by ``OVERLAP``."""
    held, size, fresh = [], 0, False
    for start, opener in streams:
        for piece in _Stream(memoryview(data)[start:], opener):
            held.append(piece)
            size += len(piece)
            fresh = True
            if size >= MAX_LAYER_BYTES:
                out = b"".join(held)
                yield out
                held, fresh = [out[-OVERLAP:]], False
                size = len(held[0])
    if fresh:
        yield b"".join(held)


def _unfolded(data: bytes, raw: bool = False):
    """(text, start and end in ``data``) of the compressed streams in ``data``; with ``raw``, also as one raw
    deflate stream.  Streams inside streams are found when their layer is opened in turn."""
    found = _members(data) if _ANY_MAGIC.search(data) else []
    if raw and not (found and found[0][0] == 0) and data[0] & 6 != 6:
        def opener():
            return zlib.decompressobj(-15)
        stream = _Stream(memoryview(data), opener)
        if any([_READABLE.search(piece) is not None for piece in stream]):
            found = [*found, [0, stream.length, [(0, opener)], stream.whole]]
    for start, end, streams, _ in found:
        for out in _windows(data, streams):
            if _READABLE.search(out) or _ANY_MAGIC.search(out):
                yield out.decode("latin-1"), start, end


def _compressed_layers(text: str):
    """(text, start, end) of compressed data that stands in ``text`` as characters of one byte each."""
    if _ANY_MAGIC_TEXT.search(text):
        for m in _BYTES.finditer(text):
            for s, a, b in _unfolded(m.group().encode("latin-1")):
                yield (s, *(np.broadcast_to(np.int64(m.start() + at), len(s)) for at in (a, b)))


def _rewritten(text: str, pattern: re.Pattern, decode) -> tuple[str, np.ndarray, np.ndarray, np.ndarray] | None:
    """The text with every decodable match replaced: (new text, start and end in ``text`` per character,
    whether the character was decoded)."""
    parts, begin, end, new, at = [], [], [], [], 0

    def keep(a, b):
        if a < b:
            parts.append(text[a:b])
            begin.append(np.arange(a, b))
            end.append(np.arange(a + 1, b + 1))
            new.append(np.zeros(b - a, dtype=bool))

    for m in pattern.finditer(text):
        got = decode(m.group())
        if got is None:
            continue
        s, lo, hi = got
        keep(at, m.start())
        parts.append(s)
        begin.append(lo + m.start())
        end.append(hi + m.start())
        new.append(np.ones(len(s), dtype=bool))
        at = m.end()
    if not parts:
        return None
    keep(at, len(text))
    return "".join(parts), np.concatenate(begin), np.concatenate(end), np.concatenate(new)


def _url(run: str):
    s = bytes.fromhex(run.replace("%", "")).decode("latin-1")
    at = np.arange(len(s)) * 3
    return s, at, at + 3


def _wide(run: str):
    s = run[1::2] if run[0] == "\0" else run[::2]
    at = np.arange(len(s)) * 2
    return s, at, at + 2


def _escape(run: str):
    s, lo, hi = [], [], []
    for m in _ESCAPE_ONE.finditer(run):
        if m.group(7) or m.group(8):
            for c in _CONTROL.get(m.group(7), m.group(7)) if m.group(7) else unescape(m.group(8)):
                s.append(c)
                lo.append(m.start())
                hi.append(m.end())
            continue
        code = next(int(g, 10 if i == 4 else 16) for i, g in enumerate(m.groups()) if g is not None)
        low = code - 0xDC00
        if s and 0 <= low < 0x400 and 0xD800 <= ord(s[-1]) < 0xDC00:       # second half of a surrogate pair
            s[-1] = chr(0x10000 + ((ord(s[-1]) - 0xD800) << 10) + low)
            hi[-1] = m.end()
            continue
        s.append(chr(code) if code <= 0x10FFFF else "\ufffd")
        lo.append(m.start())
        hi.append(m.end())
    out = "".join("\ufffd" if 0xD800 <= ord(c) < 0xE000 else c for c in s)
    return out, np.array(lo, dtype=np.int64), np.array(hi, dtype=np.int64)


def _base64_layers(text: str):
    """(text, start, end) of every base64 run that decodes to some text, directly or after decompression.

    A run may start after other letters of its alphabet (a path, a name), so it is read at all four phases."""
    for m in _BASE64.finditer(text):
        run = m.group()
        place = None
        body = run.rstrip("=")
        if breaks := [x.span() for x in _BREAK.finditer(run)]:
            kept = np.ones(len(body), dtype=bool)
            for a, b in breaks:
                kept[a:b] = False
            place = np.flatnonzero(kept)
            body = _BREAK.sub("", body)
        if _WORDLIKE.fullmatch(body) and (len(body) < 16 or body.islower() or body.isdigit()):
            continue
        n = len(body)
        body = body.replace("-", "+").replace("_", "/")
        chars = m.start() + (np.arange(n) if place is None else place)

        def spans(k, lo, hi):                      # of bytes lo to hi, read from character k on
            return chars[k + lo * 8 // 6], chars[np.minimum(k - (-hi * 8 // 6), n) - 1] + 1

        for k in range(4):
            size = (n - k) * 6 // 8
            if size < SHORTEST:
                break
            part = body[k:n - ((n - k) % 4 == 1)]
            data = binascii.a2b_base64(part + "=" * (-len(part) % 4))
            if _READABLE.search(data):
                at = np.arange(len(data))
                yield data.decode("latin-1"), *spans(k, at, at + 1)
            for s, a, b in _unfolded(data, raw=True):      # no place inside the run for a compressed character
                lo, hi = spans(k, a, b)
                yield s, np.broadcast_to(lo, len(s)), np.broadcast_to(m.end() if b == len(data) else hi, len(s))


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int, str]]]:
    """(base findings, findings of decoded layers): (start, kind, end[, depth, value]) in ``text``.

    The worklist holds layers still to unwrap; it ends when no decoding gives
    a text that was not seen before.
    """
    base = find_secrets(text)
    if not any(c in text for c in "%\\&\0") and not _BASE64.search(text):
        return base, []
    added, seen = [], {hashlib.sha256(text.encode()).digest()}
    work = [(_opened(text, False), None, None)]      # layers being opened, each inside the one before it
    while work:
        layers, lo, hi = work[-1]
        s, a, b, new, squeezed = next(layers, (None,) * 5)
        if s is None:
            work.pop()
            continue
        if not s:
            continue
        if lo is not None:
            a, b = _taken(lo, a), _taken(hi, b, 1)
        # Only what a decoding touched is new: the rest was scanned in the layer above.
        mark = hashlib.sha256(s.encode() + a[:1].tobytes() + b[-1:].tobytes()).digest()
        if mark in seen:
            continue
        seen.add(mark)
        for x, kind, y in find_secrets(s):
            if new is None or new[x:y].any():
                added.append((int(a[x]), kind, int(b[y - 1]), len(work), s[x:y]))
        work.append((_opened(s, squeezed), a, b))
    return base, added


def _taken(values: np.ndarray, at: np.ndarray, back: int = 0) -> np.ndarray:
    """``values[at - back]``; one place for all characters, as compressed data has it, stays one number."""
    return np.broadcast_to(values[at[0] - back], len(at)) if at.strides == (0,) else values[at - back]


def _opened(layer: str, squeezed: bool):
    """(text, start, end, new characters or None for all, may hold compressed data) of the layers right below."""
    for pattern, decode, marks in ((_URL, _url, "%"), (_ESCAPE, _escape, "\\&"), (_WIDE, _wide, "\0")):
        if any(c in layer for c in marks):
            got = _rewritten(layer, pattern, decode)
            if got is not None:
                yield *got, True
    for got in _base64_layers(layer):
        yield *got, None, got[1].strides == (0,)     # a run's compressed data is opened here, with the run's own ends
    if squeezed:
        for got in _compressed_layers(layer):
            yield *got, None, True


def joined(spans) -> str:
    """kind:start:end, by start, then kind as listed, then end; each once."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted({s[:3] for s in spans}))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, findings) of every row.

    A null text counts as empty: no findings, the hash of the empty text.
    ``findings`` holds (kind, start, end, depth, value): depth 0 is the text
    itself.  Repeated rows are scanned each; ids are passed through, nulls too.
    """
    import pyarrow as pa

    kind = dict(docs.dtypes)[id_col]
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32()),
                      ("value", pa.string())])

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("n0", "n1", "n2", "sha", "spans", "findings")}
            for cell in batch.column(1):
                text = cell.as_py() or ""
                base, added = scan_text(text)
                for k in range(3):
                    out[f"n{k}"].append(sum(s[1] == k for s in base))
                out["sha"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + added))
                out["findings"].append(
                    [{"kind": KINDS[s[1]], "start": s[0], "end": s[2], "depth": s[3], "value": s[4]}
                     for s in sorted({*((a, k, b, 0, text[a:b]) for a, k, b in base), *added})])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(out[f"n{k}"], pa.int64()) for k in range(3)],
                 pa.array(out["sha"], pa.string()), pa.array(out["spans"], pa.string()),
                 pa.array(out["findings"], pa.list_(item))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "findings"])

    schema = (f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
              "findings array<struct<kind:string,start:bigint,end:bigint,depth:int,value:string>>")
    return (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(tv.released(run), schema))


def redact(text: str, spans, mask: str = "[REDACTED]") -> str:
    """The text with the union of the given spans replaced."""
    out, at = [], 0
    for a, b in sorted({(s[0], s[2]) for s in spans}):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def redacted_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by a mask, in the text or the encoded run that hides it; all
    rows and columns stay, clean texts unchanged and null texts null."""
    import pyarrow as pa

    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            new = []
            for cell in batch.column(at):
                text = cell.as_py()
                if text:
                    base, added = scan_text(text)
                    if base or added:
                        text = redact(text, base + added)
                new.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(tv.released(run), schema)
