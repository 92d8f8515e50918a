"""Secret scan with a worklist of decoded layers.

The text is the first layer.  Each layer is scanned and then unwrapped in every way that
applies, which puts new layers on the worklist: percent signs, escapes and character references are decoded
in place (a sign escaped over and over is one layer, since its steps differ in nothing but their number); a base64 run becomes a layer of its own, and so does what a gzip, zlib, bzip2 or xz
stream inside it holds.  The work ends when nothing new turns up: a layer whose content was
seen before is not taken again, which also stops streams that unpack to themselves.

Every layer knows, for each of its characters, the part of the original text it comes from.
A finding is reported as that part: exact for in-place decoding, the group of four characters for
base64, and the whole stream for what is packed.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.llm.common import ship_package, slices

#: The kinds of secrets in their order.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE = 8
#: Shortest base64 run that is decoded.
MIN_BASE64 = 16
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_BASE64)
#: Lines of base64 that are broken at a width.
_BREAK = re.compile(r"[\x20\t]*(?:\r?\n|(?:\\r)?\\n)[\x20\t]*(?:>[\x20\t]*)*")
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{%d,}+%s)+[A-Za-z0-9+/_-]+={0,2}" % (MIN_BASE64, _BREAK.pattern)
)
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
#: A sign that was escaped again and again, and per sign the ends of an escape that gives a sign.
_CHAIN = re.compile(
    r"[%\\&](?:25|26|5[cC]|x(?:25|26|5[cC])|u00(?:25|26|5[cC])|(?:amp|percnt|bsol|#(?:37|38|92)|#[xX](?:25|26|5[cC]));){3,}"
)
_LINK = {
    "%": re.compile(r"25|26|5[cC]"),
    "\\": re.compile(r"x(?:25|26|5[cC])|u00(?:25|26|5[cC])"),
    "&": re.compile(r"(?:amp|percnt|bsol|#(?:37|38|92)|#[xX](?:25|26|5[cC]));"),
}
#: What a stream begins with, and what unpacks it.
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00")
_STREAMS = {
    0x1F: lambda: zlib.decompressobj(31), 0x78: lambda: zlib.decompressobj(15), 0x42: bz2.BZ2Decompressor, 0xFD: lzma.LZMADecompressor,
}
#: Text inside bytes that are not all text.
_STRETCH = re.compile(
    rb"(?:[\t-\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){12,}"
)
#: Text of the ASCII characters in UTF-16, of both byte orders.
_WIDE = re.compile(rb"(?:[\t-\r\x20-\x7e]\x00){12,}|(?:\x00[\t-\r\x20-\x7e]){12,}")
#: Byte strings written with percent signs or escapes, and the tokens of one byte each.
_PERCENT_TOKEN = r"%[0-9A-Fa-f]{2}|[!-$&-~]"
_ESCAPE_TOKEN = r"""\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|&#[0-9]{1,3};|&#[xX][0-9A-Fa-f]{1,2};|\\[ntr\\'"]|[\x20-\[\]-~]"""
_BYTE_STRINGS = (
    ("%", "url", re.compile(f"(?:{_PERCENT_TOKEN})+"), re.compile(_PERCENT_TOKEN)),
    ("\\", "unicode", re.compile(f"(?:{_ESCAPE_TOKEN})+"), re.compile(_ESCAPE_TOKEN)),
    ("&#", "unicode", re.compile(f"(?:{_ESCAPE_TOKEN})+"), re.compile(_ESCAPE_TOKEN)),
)
_NAMED = {"n": 10, "t": 9, "r": 13}
#: Bytes that the compressed streams of a text may unpack to together.  Other layers are no longer than what they come
#: from; as many characters, and ``DEPTH`` copies of the text, are taken of them.  A text that needs more is marked ``unfinished``.
LAYER_BYTES = 64 << 20
DEPTH = 64
REDACTED = "[REDACTED]"


@dataclass
class Layer:
    """Text, the original place of every character's start and end, and the way it was reached."""

    text: str
    start: np.ndarray | None
    end: np.ndarray | None
    path: str = ""

    def origin(self, first: int, last: int) -> tuple[int, int]:
        """The part of the original text that the characters first to last - 1 come from."""
        if self.start is None:
            return first, last
        return int(self.start[first]), int(self.end[last - 1])


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in one layer, leftmost and without overlap for each kind."""
    found = []
    if ":" in text or "=" in text:
        found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def _unescape(piece: str) -> str:
    if piece[0] == "&":
        return html.unescape(piece)
    if piece.startswith("\\u{"):
        point = int(piece[3:-1], 16)
        return chr(point) if point < 0x110000 and not 0xD800 <= point < 0xE000 else piece
    if piece[1] == "U":
        point = int(piece[2:], 16)
        return chr(point) if point < 0x110000 and not 0xD800 <= point < 0xE000 else piece
    if piece[1] == "x":
        return chr(int(piece[2:], 16))
    units = b"".join(int(piece[i + 2 : i + 6], 16).to_bytes(2, "little") for i in range(0, len(piece), 6))
    try:
        return units.decode("utf-16-le")
    except UnicodeDecodeError:
        return piece


def _unpercent(piece: str) -> str:
    """The decoded bytes as UTF-8; bytes that are none stay as they were written."""
    raw = bytes.fromhex(piece.replace("%", ""))
    try:
        return raw.decode()
    except UnicodeDecodeError:
        kept, at = [], 0
        while at < len(raw):
            for width in (1, 2, 3, 4):
                try:
                    kept.append(raw[at : at + width].decode())
                    at += width
                    break
                except UnicodeDecodeError:
                    continue
            else:
                kept.append(piece[3 * at : 3 * at + 3])
                at += 1
        return "".join(kept)


def _shorten(piece: str) -> str:
    """A chain of escapes that each give the sign of the next, down to the last sign, in one pass."""
    sign, at = piece[0], 1
    while link := _LINK[sign].match(piece, at):
        if sign == "&":
            sign = html.unescape("&" + link.group())
        else:
            sign = chr(int(link.group()[-2:], 16))
        at = link.end()
    return sign + piece[at:]


def _in_place(layer: Layer, pattern: re.Pattern, decode, name: str) -> Layer | None:
    """The layer with every match decoded, or None if that changes nothing.

    A character that comes from a group of escapes has the whole group as its origin, unless each
    escape of the group became one character.
    """
    pieces, starts, ends, at = [], [], [], 0
    size = len(layer.text)
    start = np.arange(size, dtype=np.int32) if layer.start is None else layer.start
    end = np.arange(1, size + 1, dtype=np.int32) if layer.end is None else layer.end
    for m in pattern.finditer(layer.text):
        made = decode(m.group())
        if made == m.group() or not made:
            continue
        a, b = m.span()
        pieces += [layer.text[at:a], made]
        unit, rest = divmod(b - a, len(made))
        if rest or m.group()[:: max(1, unit)] != m.group()[0] * len(made):
            first, last = np.full(len(made), start[a], np.int32), np.full(len(made), end[b - 1], np.int32)
        else:
            first, last = start[a:b:unit], end[a + unit - 1 : b : unit]
        starts += [start[at:a], first]
        ends += [end[at:a], last]
        at = b
    if not pieces:
        return None
    text = "".join(pieces) + layer.text[at:]
    return Layer(text, np.concatenate([*starts, start[at:]]), np.concatenate([*ends, end[at:]]), f"{layer.path}>{name}")


def _text_of(raw: bytes) -> str | None:
    """UTF-8 text without control characters other than white space, else None."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return None if re.search(r"[\x00-\x08\x0e-\x1f\x7f]", text) else text


class Room:
    """What is left of ``LAYER_BYTES`` for streams, the runs decoded so far, and the parts of the text with layers not taken."""

    def __init__(self, size: int) -> None:
        self.left = size
        self.runs: set[tuple[str, tuple[int, int]]] = set()
        self.streams: set[tuple[bytes, int, int]] = set()
        self.unscanned: list[tuple[int, int]] = []


def _unpack(raw: bytes, at: int, room: int) -> tuple[bytes, int, bool, bool]:
    """What the streams that follow each other here hold, where they end, whether they are whole, and whether they need more than ``room`` bytes."""
    out, place, whole = [], at, False
    while _MAGIC.match(raw, place):
        stream, most = _STREAMS[raw[place]](), max(1, room)
        try:
            piece = stream.decompress(memoryview(raw)[place:], most)
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            break
        out.append(piece)
        room -= len(piece)
        if not stream.eof:
            return b"".join(out), len(raw), False, len(piece) >= most
        whole, place = True, len(raw) - len(stream.unused_data)
    return b"".join(out), place, whole, False


def _layer_of(raw: bytes, first: np.ndarray, last: np.ndarray, path: str) -> Layer:
    """The text of bytes whose origins are known."""
    text = raw.decode()
    if len(text) == len(raw):
        return Layer(text, first, last, path)
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return Layer(text, first[starts], last[np.append(starts[1:], len(raw)) - 1], path)


def _layers_of(raw: bytes, first: np.ndarray, last: np.ndarray, path: str, room: Room, texts: bool = True) -> list[Layer]:
    """Texts in bytes (not those of the bytes themselves without ``texts``) and in the streams that begin anywhere in them."""
    made, work = [], [(raw, first, last, path, texts)]
    while work:
        raw, first, last, path, texts = work.pop()
        if texts and _text_of(raw) is not None:
            made.append(_layer_of(raw, first, last, path))
            continue
        if texts:
            for m in _WIDE.finditer(raw):
                a, b = m.span()
                made.append(_layer_of(m.group().replace(b"\x00", b""), first[a:b:2], last[a + 1 : b : 2], path))
            made += [_layer_of(m.group(), first[slice(*m.span())], last[slice(*m.span())], path) for m in _STRETCH.finditer(raw)]
        at = 0
        while m := _MAGIC.search(raw, at):
            out, end, whole, short = _unpack(raw, m.start(), room.left)
            at = end if whole or short else m.start() + 1
            if not out:
                continue
            left, right = int(first[m.start()]), int(last[end - 1])
            mark = (hashlib.blake2b(out, digest_size=16).digest(), left, right)
            if mark in room.streams:  # streams may hold themselves
                continue
            room.streams.add(mark)
            room.left -= len(out)
            if short:
                room.unscanned.append((left, right))
            work.append((out, np.full(len(out), left, np.int32), np.full(len(out), right, np.int32), f"{path}>unpacked", True))
    return made


def _decoded_runs(layer: Layer, room: Room) -> list[Layer]:
    made = []
    for m in [*_BASE64.finditer(layer.text), *(_WRAPPED.finditer(layer.text) if "\n" in layer.text or "\\n" in layer.text else ())]:
        spot = (m.group(), layer.origin(*m.span()))
        if spot in room.runs:  # a layer decoded in place has the runs of the one before
            continue
        room.runs.add(spot)
        run = m.group().rstrip("=")
        place = np.arange(m.start(), m.start() + len(run), dtype=np.int32)
        if _BREAK.search(run):
            kept = np.ones(len(run), bool)
            for gap in _BREAK.finditer(run):
                kept[slice(*gap.span())] = False
            place, run = place[kept], _BREAK.sub("", run)
        left = place if layer.start is None else layer.start[place]
        right = place + 1 if layer.end is None else layer.end[place]
        if m.group().endswith("="):  # a run has its padding
            right = right.copy()
            right[-1] = layer.origin(m.end() - 1, m.end())[1]
        run = run.replace("-", "+").replace("_", "/")
        for shift in range(4):  # characters of the same alphabet may stand before
            size = len(run) - shift
            size -= size % 4 == 1
            raw = base64.b64decode(run[shift : shift + size] + "=" * (-size % 4))
            quad = shift + 4 * (np.arange(len(raw), dtype=np.int32) // 3)
            made += _layers_of(raw, left[quad], right[np.minimum(quad + 4, len(run)) - 1], f"{layer.path}>base64", room)
    for mark, name, strings, token in _BYTE_STRINGS:
        if mark not in layer.text:
            continue
        for m in strings.finditer(layer.text):
            if mark not in m.group():
                continue
            spot = (m.group(), layer.origin(*m.span()))
            if spot in room.runs:
                continue
            room.runs.add(spot)
            tokens = [(_byte(x.group()), x.start() + m.start(), x.end() + m.start()) for x in token.finditer(m.group())]
            raw = bytes(x[0] for x in tokens)
            if _MAGIC.search(raw):
                first = np.array([layer.origin(a, b)[0] for _, a, b in tokens], np.int32)
                last = np.array([layer.origin(a, b)[1] for _, a, b in tokens], np.int32)
                made += _layers_of(raw, first, last, f"{layer.path}>{name}", room, texts=False)
    return made


def _byte(token: str) -> int:
    if len(token) == 1:
        return ord(token)
    if token[0] == "%" or token[:2] in ("\\x", "\\u"):
        return int(token[-2:], 16)
    if token[0] == "&":
        return (int(token[3:-1], 16) if token[2] in "xX" else int(token[2:-1])) & 255
    return _NAMED.get(token[1], ord(token[1]))


def layers(text: str, layer_bytes: int = LAYER_BYTES, unscanned: list[tuple[int, int]] | None = None) -> Iterator[tuple[Layer, bool]]:
    """The text and all layers inside it, until no new one appears; with each, whether something in it was not taken.

    ``unscanned`` is given the parts of the text that such layers come from.
    """
    work, seen = deque([Layer(text, None, None)]), set()
    room, steps = Room(layer_bytes), DEPTH * len(text) + layer_bytes
    while work:
        layer = work.popleft()
        before = len(room.unscanned)
        if layer.path:
            mark = (hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), layer.origin(0, len(layer.text)))
            if mark in seen:
                continue
            seen.add(mark)
            # what streams hold has its own bound
            steps -= 0 if layer.path.endswith(">unpacked") else len(layer.text)
            if steps <= 0:
                part = layer.origin(0, len(layer.text))
                if unscanned is not None:
                    unscanned.append(part)
                yield Layer("", None, None, layer.path), True
                continue
        found = _decoded_runs(layer, room)
        if unscanned is not None:
            unscanned += room.unscanned[before:]
        yield layer, len(room.unscanned) > before
        if made := _in_place(layer, _CHAIN, _shorten, "chain"):
            work += [x for x in [*found, made] if x.text]
            continue
        if "%" in layer.text and (made := _in_place(layer, _PERCENT, _unpercent, "url")):
            found.append(made)
        if ("\\" in layer.text or "&" in layer.text) and (made := _in_place(layer, _ESCAPE, _unescape, "unicode")):
            found.append(made)
        work += [x for x in found if x.text]


def find(
    text: str, layer_bytes: int = LAYER_BYTES, unscanned: list[tuple[int, int]] | None = None
) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, str]], bool]:
    """Findings of the text itself, those only its decoded layers show (with the way there), and whether room ran out."""
    base, more, unfinished = [], {}, False
    for layer, short in layers(text, layer_bytes, unscanned):
        unfinished |= short
        if not layer.path:
            base = scan(layer.text)
            known = set(base)
            continue
        for kind, first, last in scan(layer.text):
            spot = (kind, *layer.origin(first, last))
            if spot not in known:
                more.setdefault(spot, layer.path[1:])
    return base, [(*spot, path) for spot, path in more.items()], unfinished


def _joined(spans: list[tuple[str, int, int]]) -> str:
    spans = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every stretch covered by spans replaced."""
    out, at, covered = [], 0, 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= covered:
            out += [text[at:start], REDACTED]
        covered = at = max(covered, end)
    return "".join(out) + text[at:]


_SCHEMA = (
    "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
    "n_decoded bigint, paths string, unfinished boolean"
)


def _row(text: str, layer_bytes: int) -> tuple:
    base, more, unfinished = find(text, layer_bytes)
    counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
    digest = hashlib.sha256(_joined(base).encode()).hexdigest()
    return (*counts, digest, _joined(base + [m[:3] for m in more]), len(more), ",".join(sorted({m[3] for m in more})), unfinished)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", layer_bytes: int = LAYER_BYTES) -> DataFrame:
    """One row per row of ``docs``: counts and digest of what the text shows, and all spans.

    ``spans`` joins kind:start:end (code points of the original text, end exclusive) of the findings in the text
    and in its decoded layers, by start, then kind, then end; equal spans once.  ``n_decoded`` counts those
    only the layers show, ``paths`` lists the ways to them.  Null and empty texts have no findings
    and the digest of empty text.  ``unfinished`` marks a text whose streams unpack to more than ``layer_bytes``,
    so that a decompression bomb is reported and costs no memory, or whose other layers go deeper than ``DEPTH`` copies of a long
    text: all that fits is scanned, also after the first layer that does not.  Repeated rows and
    null ids are answered like any other; other columns are not read.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded", "paths", "unfinished"]
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.string(), pa.bool_()]
        for batch in slices(batches, "text"):
            rows = [_row(t, layer_bytes) for t in batch.column("text").to_pylist()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    chosen = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))
    return chosen.mapInArrow(run, f"doc_id bigint, {_SCHEMA}")


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = None, layer_bytes: int = LAYER_BYTES) -> DataFrame:
    """``docs`` with every finding in ``text_col`` replaced by ``REDACTED``, rows and columns as they were.

    ``length_col`` names a column that holds the text's length in characters; it is kept true.  Null stays null.
    Texts without findings are unchanged.  A part of a text with layers that ``scan_secrets`` would report as ``unfinished``
    is replaced too, as nobody has seen what is in it.
    """
    ship_package(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            clean = []
            for text in batch.column(place).to_pylist():
                unseen: list[tuple[int, int]] = []
                base, more, _ = find(text, layer_bytes, unseen) if text else ([], [], False)
                spans = base + [m[:3] for m in more] + [("unscanned", *part) for part in unseen]
                clean.append(redact(text, spans) if spans else text)
            yield batch.set_column(place, batch.schema.field(place), pa.array(clean, batch.schema.field(place).type))

    done = docs.mapInArrow(run, docs.schema)
    if length_col:
        done = done.withColumn(length_col, F.when(F.col(f"`{text_col}`").isNull(), F.col(f"`{length_col}`")).otherwise(
            F.length(F.col(f"`{text_col}`")).cast(docs.schema[length_col].dataType)
        )).select(*[F.col(f"`{c}`") for c in docs.columns])
    return done
