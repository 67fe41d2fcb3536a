"""Secret scans over a text and everything encoded in it.

A worklist holds layers of a text: first the text, then whatever URL, Unicode, base64 or compressed encodings in a layer
unwrap to, until nothing new appears. A layer whose text and places in the original were met before is not opened again,
nor one whose text is that of a layer it comes from, which ends cycles. Each layer is scanned by the same rules; every character of a layer knows the stretch of the original it came from, so
findings are reported as spans of the original.

Work is local to a row: no shuffle, and a lost executor costs only its rows.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from array import array
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.catalog import query, table

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: a text without these in any case has no assignment
KEYWORDS = ("passw", "secret", "token", "api")
#: a percent sign that was encoded again and again is unwrapped at once
PERCENT = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+")
PERCENT_BYTE = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#(?:x([0-9A-Fa-f]{1,6})|([0-9]{1,7}));|\\u\{([0-9A-Fa-f]{1,6})\}|\\([0-3][0-7]{2})")
#: escaped bytes that may be packed or UTF-8
BYTES = re.compile(r"(?:\\x[0-9A-Fa-f]{2}|\\[0-3][0-7]{2}){2,}")
BYTE = re.compile(r"\\x([0-9A-Fa-f]{2})|\\([0-3][0-7]{2})")
#: token=abcdef, the shortest finding, encodes to 16 characters
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: runs that are parted by single line breaks only
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[A-Za-z0-9+/_-]++)++={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
#: bytes of one unpacked stream; a longer one stays packed
MOST_UNPACKED = 1 << 26


#: a stretch of readable UTF-8 within other bytes, as long as the shortest finding
READABLE = re.compile(rb"(?:[\t\r\n\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){12,}")
#: how packed streams begin
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY|\xfd7zXZ\x00", re.S)


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the findings in one layer; leftmost, not overlapping within a kind."""
    out = []
    small = text.lower()
    if any(k in small for k in KEYWORDS):
        out += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), 1) for m in ACCESS.finditer(text)]
    return out + [(*m.span(), 2) for m in HEX.finditer(text)]


class Layer:
    """A text and, for each of its characters, where in the original it begins and ends."""

    __slots__ = ("text", "starts", "ends", "above")

    def __init__(self, text, starts, ends):
        self.text, self.starts, self.ends = text, starts, ends
        self.above = frozenset()  # the texts of the layers that it comes from

    def key(self) -> tuple:
        """Of text and places."""
        places = (array("q", x).tobytes() for x in (self.starts, self.ends))
        return self.text, hashlib.md5(b"".join(places)).digest()

    def span(self, a: int, b: int) -> tuple[int, int]:
        return self.starts[a], self.ends[b - 1]

    def replaced(self, parts: list[tuple[int, int, str, list[tuple[int, int]]]]):
        """A new layer with stretches (a, b) replaced by texts, each of whose characters has a stretch of this layer."""
        text, starts, ends, at = [], [], [], 0
        for a, b, new, places in parts:
            text += [self.text[at:a], new]
            starts += [*self.starts[at:a], *(self.starts[i] for i, _ in places)]
            ends += [*self.ends[at:a], *(self.ends[j - 1] for _, j in places)]
            at = b
        return Layer("".join([*text, self.text[at:]]), starts + [*self.starts[at:]], ends + [*self.ends[at:]])


def characters(raw: bytes, place) -> tuple[str, list[tuple[int, int]]] | None:
    """UTF-8 bytes as characters, each with the stretch from its first to its last byte; None if they are no text."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    places, at = [], 0
    for c in text:
        n = len(c.encode())
        places.append((place(at)[0], place(at + n - 1)[1]))
        at += n
    return text, places


def opened(raw: bytes, most: int) -> bytes | None:
    """What the packed streams at the beginning of ``raw`` unpack to, through all layers of packing; None if it is not packed."""
    found, met = None, set()  # a stream can unpack to itself
    while raw not in met and (inner := unpacked(raw, most)) is not None:
        met.add(raw)
        found = raw = inner
    return found


def replacement(raw: bytes, units: list[tuple[int, int]], most: int) -> tuple[str, list[tuple[int, int]]] | None:
    """Characters for the bytes that stand in ``units`` of a layer: text as it is, or the content of a packed stream."""
    if (inner := opened(raw, most)) is not None:
        whole = units[0][0], units[-1][1]
        return characters(inner, lambda i: whole)
    return characters(raw, lambda i: units[i])


def unpercent(layer: Layer, most: int) -> Layer | None:
    parts = []
    for m in PERCENT.finditer(layer.text):
        units = [(u[1], u.span()) for u in PERCENT_BYTE.finditer(m[0])]
        places = [(m.start() + a, m.start() + b) for _, (a, b) in units]
        got = replacement(bytes.fromhex("".join(h for h, _ in units)), places, most)
        if got:
            parts.append((*m.span(), *got))
    return layer.replaced(parts) if parts else None


def unbyte(layer: Layer, most: int) -> Layer | None:
    """Escaped bytes read together: UTF-8 of several bytes, or packed streams."""
    parts = []
    for m in BYTES.finditer(layer.text):
        units = [(int(u[1], 16) if u[1] else int(u[2], 8), (m.start() + u.start(), m.start() + u.end())) for u in BYTE.finditer(m[0])]
        got = replacement(bytes(v for v, _ in units), [p for _, p in units], most)
        if got:
            parts.append((*m.span(), *got))
    return layer.replaced(parts) if parts else None


def unescape(layer: Layer) -> Layer | None:
    parts, held = [], None
    for m in ESCAPE.finditer(layer.text):
        code = int(m[1] or m[2] or m[3] or m[5] or "0", 16) or int(m[4] or "0") or int(m[6] or "0", 8)
        if held and held[1] == m.start() and 0xDC00 <= code < 0xE000:  # the second half of a pair
            parts.append((held[0], m.end(), chr(0x10000 + ((held[2] - 0xD800) << 10) + code - 0xDC00), [(held[0], m.end())]))
        elif 0 < code < 0x110000 and not 0xD800 <= code < 0xE000:
            parts.append((*m.span(), chr(code), [m.span()]))
        held = (*m.span(), code) if 0xD800 <= code < 0xDC00 else None
    return layer.replaced(parts) if parts else None


def _machine(raw: bytes):
    """What unpacks the zlib, gzip, bz2 or xz stream that ``raw`` begins with; None if it begins with none."""
    if raw[:2] == b"\x1f\x8b" or (raw[:1] == b"\x78" and len(raw) > 1 and (raw[0] * 256 + raw[1]) % 31 == 0):
        return zlib.decompressobj(47)
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if raw[:6] == b"\xfd7zXZ\x00" else None


def unpacked(raw: bytes, most: int) -> bytes | None:
    """The content of zlib, gzip, bz2 or xz streams, one behind the other, as far as they have ``most`` bytes together,
    the last as far as it goes if it is cut off; None if the first is none of them, is damaged or is longer."""
    out, left = [], most
    while (machine := _machine(raw)) is not None:
        try:
            out.append(machine.decompress(raw, left + 1))
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            break
        left -= len(out[-1])
        if left < 0 or not machine.eof:
            if left < 0 or not out[-1]:
                out.pop()  # too long, or cut off before anything came out; what else was cut off is read as far as it goes
            break
        raw = machine.unused_data.lstrip(b"\0")  # members may be padded
    return b"".join(out) if out else None


def stretches(text: str):
    """(characters, place of each, start, end) of what may be base64: each run, and runs joined over line breaks.

    Lines of one width are joined with and without the lines before and after, which may be words of the text.
    """
    for m in BASE64.finditer(text):
        body = m[0].rstrip("=")
        yield body, range(m.start(), m.start() + len(body)), *m.span()
    for m in WRAPPED.finditer(text):
        lines = [x.span() for x in LINE.finditer(text, *m.span())]
        picked, at = {(0, len(lines))}, 0
        for _, same in itertools.groupby(lines, lambda x: x[1] - x[0]):
            a, at = at, at + sum(1 for _ in same)
            picked |= {(max(0, i), min(len(lines), j)) for i in (a - 1, a) for j in (at, at + 1)}
        for i, j in sorted(picked):
            some = lines[i:j]
            if j - i > 1 and sum(b - a for a, b in some) >= 16:
                end = m.end() if j == len(lines) else some[-1][1]
                yield "".join(text[a:b] for a, b in some), [k for a, b in some for k in range(a, b)], some[0][0], end


def _decoded(body: str) -> bytes | None:
    body = body[:-1] if len(body) % 4 == 1 else body
    try:
        return base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None


def unbase64(layer: Layer, most: int) -> list[Layer]:
    """One layer for each stretch that decodes to text, or to packed text.

    A run may have other characters in front, such as a path or a prefix, and behind: it is decoded at each of the four
    alignments, and what is readable or packed within the bytes is taken too.
    """
    out = []

    def take(raw: bytes, place, packed: bool) -> None:
        got = characters(raw, place)
        if got and got[0] and (packed or sum(c.isprintable() or c in "\t\r\n" for c in got[0]) >= 0.95 * len(got[0])):
            text, places = got
            out.append(Layer(text, [layer.starts[a] for a, _ in places], [layer.ends[b - 1] for _, b in places]))

    for body, at, begin, end in stretches(layer.text):
        for skip in range(min(4, len(body) - 15)):
            raw = _decoded(body[skip:])
            if raw is None:
                continue
            n = len(body)

            def place(i, at=at, skip=skip, n=n):
                return at[min(n - 1, skip + i * 8 // 6)], at[min(n - 1, skip + (i * 8 + 7) // 6)] + 1

            inner = opened(raw, most)
            if inner is not None:
                take(inner, lambda i, w=(at[skip], end): w, True)
                continue
            if skip == 0 and len(body) % 4 != 1:
                before = len(out)
                take(raw, place, False)
                if len(out) > before:
                    break  # all of the run is text: other alignments are not
            for m in READABLE.finditer(raw):
                take(m[0], lambda i, s=m.start(), place=place: place(s + i), False)
            for m in PACKED.finditer(raw, 1):
                if (inner := opened(raw[m.start():], most)) is not None:
                    take(inner, lambda i, w=(place(m.start())[0], end): w, True)
    return out


def spans_of(text: str, most: int = MOST_UNPACKED) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(findings in the text itself, findings in all layers), as (start, end, kind) of the original, sorted and distinct."""
    base = sorted(scan(text), key=lambda x: (x[0], x[2]))
    every = set(base)
    if "%" in text or "\\" in text or "&#" in text or BASE64.search(text) or WRAPPED.search(text):
        work = deque([Layer(text, range(len(text)), range(1, len(text) + 1))])
        seen = set()
        while work:
            layer = work.popleft()
            above = layer.above | {layer.text}
            for new in [unpercent(layer, most), unbyte(layer, most), unescape(layer), *unbase64(layer, most)]:
                # the same text from another place has spans of its own
                if new is not None and new.text not in above and (key := new.key()) not in seen:
                    seen.add(key)
                    new.above = above
                    work.append(new)
                    every.update((*new.span(a, b), k) for a, b, k in scan(new.text))
    return base, sorted(every, key=lambda x: (x[0], x[2], x[1]))


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find_secrets(docs: DataFrame, most: int = MOST_UNPACKED) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, one row for each row of ``docs``.

    Counts and digest are of the findings in the text itself; ``spans`` has those of all layers, mapped to the text.
    Null and empty texts have none: counts 0 and the digest of the empty string. Findings of one kind that map to the
    same stretch are listed once. Packed streams that unpack to more than ``most`` bytes stay packed. An empty table gives no
    rows; columns not named do not matter. Texts may be of any length: time and memory grow with it.
    """
    columns = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def made(batches):
        for b in batches:
            ids, rows = b.column(0), []
            for text in b.column(1):
                base, every = spans_of(text.as_py() or "", most)
                counts = [sum(k == n for *_, k in base) for n in range(3)]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            got = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, pa.int64()) for c in got[:3]), *(pa.array(c, pa.string()) for c in got[3:])],
                [x.split()[0] for x in columns.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(made, columns)


@query("op6_secrets")
def op6_secrets(spark, folder):
    return find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
