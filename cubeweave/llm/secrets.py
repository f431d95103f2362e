"""Secrets, also inside nested encodings.

A worklist holds the layers of a text. Each layer is scanned, then unwrapped in
place by every decoder that finds something in it: percent-encoded runs, Unicode
escapes, and base64, compressed or not, in one line or wrapped. What comes out is a new layer unless it
has been seen, so the list ends even where a layer decodes to itself. A layer
knows for each of its characters where it comes from in the text, so that spans
found in it are spans of the text. A compressed block that grows beyond
``IN_PLACE`` bytes stays where it is; what it holds is read in overlapping parts,
each a layer that comes from the whole block.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import bz2
import codecs
import hashlib
import lzma
import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order.
KINDS = ["assign", "access", "hex"]
_PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII),
    "access": re.compile("AKIA[A-Z0-9]{16,}"),
    "hex": re.compile("[0-9a-f]{24,}"),
}
# a percent sign that is encoded again and again is one character
_URL_UNIT = re.compile("%(?:25)*([0-9A-Fa-f]{2})")
_URL = re.compile("(?:%(?:25)*[0-9A-Fa-f]{2})+")
_VALID = re.compile("[^\udc80-\udcff]+")
_ESCAPE = re.compile(
    r"\\u([dD][89abAB][0-9A-Fa-f]{2})\\u([dD][c-fC-F][0-9A-Fa-f]{2})|\\u(?:005[cC]u)*([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
    r"|\\u\{([0-9A-Fa-f]{1,6})\}|%u([0-9A-Fa-f]{4})"
)
_BASE64 = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")
_MARK = re.compile("[+/_-]")
_PIECE = re.compile("[A-Za-z0-9]{16,}={0,2}")
#: The first row of a wrapped block, a break, and another row; rows of PEM headers are none.
_FIRST = re.compile("[A-Za-z0-9+/_-]{16,}")
_BREAK = re.compile(r"[\x20\t]*(?:\r\n?|\n)[\x20\t]*")
_ROW = re.compile("(?!----)[A-Za-z0-9+/_-]+")
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f�]")
#: What a text must have before it is looked at (checked for a whole column at once).
_SIGNS = {
    "assign": "(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]",
    "access": "AKIA[A-Z0-9]{16}",
    "hex": "[0-9a-f]{24}",
    "url": "%[0-9A-Fa-f]{2}",
    "escape": r"\\[uUx][0-9A-Fa-f]{2}|&#[x0-9]|\\u\{[0-9A-Fa-f]|%u[0-9A-Fa-f]{4}",
    "base64": "[A-Za-z0-9+/_-]{16}",
    "wrapped": r"[A-Za-z0-9+/_-]{16}[ \t]*[\r\n]",
}
#: A compressed block that grows beyond this many bytes is read in parts.
IN_PLACE = 1 << 26
#: Bytes of a part, and characters that two parts share (more where a run of encoded characters is longer).
PART, SHARED = 1 << 23, 1 << 20
#: Bytes that unpacking may need besides what comes out; blocks that need more are counted.
MEMORY = 1 << 28
#: A compressed block that would grow beyond this many bytes is not unwrapped but counted. There is no such limit unless one is set.
MOST_INFLATED = math.inf
_NO_RUN = re.compile(r"[^A-Za-z0-9+/_=%\\&#;\r\n-]")
_BROKEN = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError)


class TooLarge(Exception):
    """A compressed block is larger than MOST_INFLATED, or needs too much memory."""


class InParts(Exception):
    """A compressed block is larger than IN_PLACE; ``parts`` are the texts it holds."""

    def __init__(self, parts: Iterator[str | None]) -> None:
        self.parts = parts


@dataclass
class Layer:
    """A text, where its characters begin and end in the root text (None: it is the root), and how it was unwrapped."""

    text: str
    begin: np.ndarray | None = None
    end: np.ndarray | None = None
    path: tuple[str, ...] = ()

    def root(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.begin is None else (int(self.begin[a]), int(self.end[b - 1]))


def scan(text: str, kinds: list[str] = KINDS) -> Iterator[tuple[str, int, int]]:
    """Secrets of a text: kind, start, end."""
    for kind in kinds:
        for m in _PATTERNS[kind].finditer(text):
            if kind != "assign" or m.end(2) - m.start(2) >= 6:
                yield kind, *m.span()


# A decoder yields, for runs of a text, (start, end, decoded text, start and end of each decoded character in the run).
# Without a decoded text the run stays; then the third to last are None, its parts (None: it is refused), None.


def _url(text: str) -> Iterator[tuple]:
    for m in _URL.finditer(text):
        units = list(_URL_UNIT.finditer(m[0]))
        out = bytes.fromhex("".join(u[1] for u in units)).decode(errors="surrogateescape")
        width = np.cumsum([len(u[0]) for u in units])
        ends = width[np.cumsum(np.fromiter((len(c.encode(errors="surrogateescape")) for c in out), np.int64, len(out))) - 1]
        begins = np.concatenate([[0], ends[:-1]])
        for part in _VALID.finditer(out):  # bytes that are no UTF-8 stay
            a, b = part.span()
            lo, hi = int(begins[a]), int(ends[b - 1])
            yield m.start() + lo, m.start() + hi, part[0], begins[a:b] - lo, ends[a:b] - lo


def _escapes(text: str) -> Iterator[tuple]:
    for m in _ESCAPE.finditer(text):
        high, low, four, eight, two, hexa, deci, braced, percent = m.groups()
        code = 0x10000 + ((int(high, 16) - 0xD800) << 10) + int(low, 16) - 0xDC00 if high else int(deci) if deci else int(four or eight or two or hexa or braced or percent, 16)
        if code <= 0x10FFFF and not 0xD800 <= code < 0xE000:
            yield *m.span(), chr(code), np.zeros(1, dtype=np.int64), np.full(1, m.end() - m.start(), dtype=np.int64)


def _members(make: Callable, magic: bytes, source: Iterator[bytes]) -> Iterator[bytes]:
    """What a block holds, member by member: one ends, another begins with ``magic``. What follows the last is no part of it."""
    unpack, whole = make(), False
    for data in source:
        while True:
            try:
                out = unpack.decompress(data, PART)
            except _BROKEN:
                if whole:  # what follows looked like a member
                    return
                raise
            data = getattr(unpack, "unconsumed_tail", b"")
            if out:
                yield out
            if unpack.eof:
                whole, data = True, unpack.unused_data.lstrip(b"\0")
                while len(data) < len(magic) and (more := next(source, b"")):
                    data = (data + more).lstrip(b"\0")
                if not magic or not data.startswith(magic):
                    return
                unpack = make()
            elif not out and not data:
                break


def _frames(source: Iterator[bytes]) -> Iterator[bytes]:
    """The same for frames of zstd, which tell where they end. Few bytes at once: they can grow to PART."""
    make, whole, data = zstandard.ZstdDecompressor(max_window_size=MEMORY // 2).decompressobj, False, b""
    unpack = make()
    for piece in source:
        data += piece
        while data:
            try:
                out = unpack.decompress(data[:256])
            except _BROKEN:
                if whole:
                    return
                raise
            if out:
                yield out
            if unpack.eof:
                whole, data = True, unpack.unused_data + data[256:]
                while len(data) < 4 and (more := next(source, b"")):
                    data += more
                if not data.startswith(_ZSTD):
                    return
                unpack = make()
            else:
                data = data[256:]


_GZIP, _BZ2, _XZ, _ZSTD = b"\x1f\x8b", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd"


def _unpacker(head: bytes) -> Callable[[Iterator[bytes]], Iterator[bytes]] | None:
    """How to unpack what begins with ``head``, from pieces to pieces of at most PART bytes; None if it is not compressed."""
    if head.startswith(_GZIP):
        return lambda source: _members(lambda: zlib.decompressobj(31), _GZIP, iter(source))
    if head[:1] == b"\x78" and len(head) > 1 and (head[0] * 256 + head[1]) % 31 == 0:
        return lambda source: _members(zlib.decompressobj, b"", iter(source))
    if head.startswith(_BZ2):
        return lambda source: _members(bz2.BZ2Decompressor, _BZ2, iter(source))
    if head.startswith(_XZ):
        return lambda source: _members(lambda: lzma.LZMADecompressor(memlimit=MEMORY), _XZ, iter(source))
    if head.startswith(_ZSTD):
        return lambda source: _frames(iter(source))
    return None


def _sliced(raw: bytes) -> Iterator[bytes]:
    return (raw[i : i + 65536] for i in range(0, len(raw), 65536))


def _inflated(raw: bytes) -> bytes | None:
    """What a compressed block holds; None if it is none."""
    if (unpack := _unpacker(raw)) is None:
        return None
    out, size = [], 0
    try:
        for piece in unpack(_sliced(raw)):
            out.append(piece)
            size += len(piece)
            if size > MOST_INFLATED:
                raise TooLarge
            if size > IN_PLACE:
                raise InParts(_texts(lambda: unpack(_sliced(raw))))
    except _BROKEN as error:
        if "memory" in str(error).lower():
            raise TooLarge from error
        return None
    return b"".join(out)


def _texts(pieces: Callable[[], Iterator[bytes]], seen: frozenset = frozenset()) -> Iterator[str | None]:
    """A large text, through compressed blocks, in parts that overlap, as far as it is readable; None for what could not be read whole."""
    head = next(pieces(), b"")
    if unpack := _unpacker(head):
        try:
            inner = next(unpack(pieces()), b"")
        except _BROKEN as error:
            inner = b""
            if "memory" in str(error).lower():
                yield None
        if inner and (key := hashlib.sha256(inner).digest()) not in seen:
            yield from _texts(lambda: unpack(pieces()), seen | {key})
            return
    decoder, kept, size = codecs.getincrementaldecoder("utf-8")(), "", 0
    try:
        for piece in pieces():
            size += len(piece)
            new = decoder.decode(piece)
            if size > MOST_INFLATED:
                yield None
                return
            if _CONTROL.search(new):
                return
            text = kept + new
            yield text
            kept = text[_run_start(text, max(0, len(text) - SHARED)) :]
            if len(kept) > IN_PLACE:
                yield None
                kept = text[-SHARED:]
    except _BROKEN:
        return


def _run_start(text: str, at: int) -> int:
    """Where the run of encoded characters that reaches to ``at`` begins."""
    back = 1024
    while at > 0:
        lo = max(0, at - back)
        last = None
        for last in _NO_RUN.finditer(text, lo, at):
            pass
        if last or lo == 0:
            return last.end() if last else 0
        back *= 8
    return 0


def _readable(raw: bytes) -> str | None:
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return None if not text or _CONTROL.search(text) else text


def _plain(run: str) -> tuple[str, np.ndarray, np.ndarray] | None:
    """The text that a base64 run holds, through compressed blocks, and its characters' places."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        raw = base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None
    packed, seen = raw, set()
    while (inner := _inflated(packed)) is not None and inner not in seen:
        seen.add(packed := inner)
    text = _readable(packed)
    if text is None:
        return None
    if seen:
        return text, np.zeros(len(text), dtype=np.int64), np.full(len(text), len(run), dtype=np.int64)
    size = np.fromiter((len(c.encode()) for c in text), np.int64, len(text))
    ends = np.cumsum(size)
    return text, (ends - size) * 8 // 6, -(-ends * 8 // 6)


def _held(run: str) -> tuple | None:
    """What _plain gives; (None, parts, None) for a run that stays."""
    try:
        return _plain(run)
    except InParts as large:
        return None, large.parts, None
    except TooLarge:
        return None, None, None


def _bytes(run: str) -> bytes:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    return base64.b64decode(body[: len(body) // 4 * 4])


def _readable_bytes(raw: bytes) -> int:
    """How many bytes from the first one are readable text."""
    try:
        text = raw.decode()
    except UnicodeDecodeError as error:
        text = raw[: error.start].decode()
    bad = _CONTROL.search(text)
    return len((text[: bad.start()] if bad else text).encode())


def _ends(run: str, start: int, cuts: list[int]) -> Iterator[int]:
    """Where a block that begins at ``start`` may end: with the run, or at the last cuts up to which it is readable."""
    size, most = 256, len(run) - 1
    if _unpacker(_bytes(run[start : start + 16])):
        # the packer ignores what follows its block; one character more than whole bytes is left out
        yield len(run) - ((len(run) - start) % 4 == 1)
    else:
        while (good := _readable_bytes(raw := _bytes(run[start : start + size]))) >= len(raw) - 3 and start + size < len(run):
            size *= 4
        if good >= len(raw) - 3:
            yield len(run)
        most = start + -(-good * 8 // 6)
    last = bisect.bisect_right(cuts, most)
    yield from (c for c in reversed(cuts[max(0, last - 8) : last]) if c >= start + 16)


def _parts(run: str, starts: list[int], cuts: list[int]) -> Iterator[tuple[int, int, tuple]]:
    """Blocks in a run that is none as a whole, from some of ``starts`` on: start, end and what they hold."""
    at = 0
    for start in starts:
        if start < at or len(run) < start + 16:
            continue
        head = _bytes(run[start : start + 16])
        if _readable_bytes(head) < len(head) - 3 and not _unpacker(head):
            continue
        for end in _ends(run, start, cuts):
            if held := _held(run[start:end]):
                yield start, end, held
                at = end
                break


def _base64(text: str) -> Iterator[tuple]:
    for m in _BASE64.finditer(text):
        if whole := _held(m[0]):
            yield *m.span(), *whole
            continue
        # a path, or words joined by marks
        marks, at = [k.start() for k in _MARK.finditer(m[0])], m.start()
        blocks = [(m.start() + a, m.start() + b, held) for a, b, held in _parts(m[0], [0, *(k + 1 for k in marks)], marks)]
        for a, b, held in [*blocks, (m.end(), m.end(), None)]:
            for p in _PIECE.finditer(text, at, a):
                if p.span() != m.span() and (part := _held(p[0])):
                    yield *p.span(), *part
            if held:
                yield a, b, *held
            at = b


def _rows(text: str, first: re.Match) -> list[tuple[int, int]]:
    """Rows from ``first`` on: all but it and the last are of one width, the last is not longer; it may end in padding."""
    rows, width = [first.span()], None
    if first[0].endswith("----"):
        return rows
    while (gap := _BREAK.match(text, rows[-1][1])) and (row := _ROW.match(text, gap.end())):
        size = row.end() - row.start()
        if width is not None and size > width:
            break
        rows.append(row.span())
        if width is not None and size < width:
            break
        width = size
    a, b = rows[-1]
    rows[-1] = a, b + len(text[b : b + 2]) - len(text[b : b + 2].lstrip("="))
    return rows


def _wrapped(text: str) -> Iterator[tuple]:
    """Base64 blocks of several rows. Rows that are blocks of their own are left to _base64, which gives another layer."""
    at = 0
    while first := _FIRST.search(text, at):
        rows = _rows(text, first)
        at = rows[-1][0] if len(rows) > 1 else rows[0][1]
        if len(rows) == 1:
            continue
        run, place = "".join(text[a:b] for a, b in rows), np.concatenate([np.arange(a, b) for a, b in rows])
        ends = np.cumsum([b - a for a, b in rows]).tolist()
        starts = [0, *(k.end() for k in _MARK.finditer(run, 0, ends[0])), *ends[:-1]]
        for a, b, (out, x, y) in _parts(run, sorted(set(starts)), ends[:-1]):
            lo, hi = int(place[a]), int(place[b - 1]) + 1
            yield (lo, hi, out, x, y) if out is None else (lo, hi, out, place[a + x] - lo, place[a + y - 1] + 1 - lo)
            at = max(at, hi)


DECODERS = {"url": _url, "escape": _escapes, "base64": _base64, "wrapped": _wrapped}


def unwrap(layer: Layer, decoder: str) -> tuple[Layer | None, list[tuple]]:
    """The layer with all that the decoder finds replaced in place (None if it finds nothing), and start, end and parts of runs that stay."""
    text, at, large = [], 0, []
    begin, end = [], []
    base = (np.arange(len(layer.text)), np.arange(1, len(layer.text) + 1)) if layer.begin is None else (layer.begin, layer.end)
    for a, b, out, x, y in DECODERS[decoder](layer.text):
        if out is None:
            large.append((a, b, x))
            continue
        text += [layer.text[at:a], out]
        begin += [base[0][at:a], base[0][a + x]]
        end += [base[1][at:a], base[1][a + y - 1]]
        at = b
    if not text:
        return None, large
    text.append(layer.text[at:])
    return Layer("".join(text), np.concatenate([*begin, base[0][at:]]), np.concatenate([*end, base[1][at:]]), (*layer.path, decoder)), large


def secrets_of(text: str, base_kinds: list[str] = KINDS, decoders: list[str] | None = None) -> tuple[list[tuple], list[tuple], int]:
    """Spans of the text itself, spans that only its layers show (with the layers' names), and blocks refused."""
    order = {k: i for i, k in enumerate(KINDS)}
    base = sorted(scan(text, base_kinds), key=lambda s: (s[1], order[s[0]]))
    added: dict[tuple, str] = {}
    refused, work, seen = 0, [iter([Layer(text)])], {hashlib.sha256(text.encode()).digest()}

    def new(layer: Layer, place: str = "") -> bool:
        if (key := hashlib.sha256(place.encode() + layer.text.encode()).digest()) in seen:
            return False
        seen.add(key)
        for kind, a, b in scan(layer.text):
            added.setdefault((kind, *layer.root(a, b)), ">".join(layer.path))
        return True

    def parts(texts: Iterator[str | None], a: int, b: int, path: tuple[str, ...]) -> Iterator[Layer]:
        nonlocal refused
        for part in texts:
            if part is None:
                refused += 1
                continue
            layer = Layer(part, np.broadcast_to(a, len(part)), np.broadcast_to(b, len(part)), path)
            if new(layer, f"{a}:{b}:"):
                yield layer

    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        for decoder in decoders if decoders is not None and not layer.path else DECODERS:
            inner, large = unwrap(layer, decoder)
            for a, b, texts in large:
                place = layer.root(a, b)
                # the block stays in the layers that come after this one
                if (key := (place, hashlib.sha256(layer.text[a:b].encode()).digest())) not in seen:
                    seen.add(key)
                    work.append(parts(iter([None]) if texts is None else texts, *place, (*layer.path, decoder)))
            if inner is not None and new(inner):
                work.append(iter([inner]))
    known = {k: [s for s in base if s[0] == k] for k in KINDS}
    more = [(*s, path) for s, path in added.items() if not any(a <= s[1] and s[2] <= b for _, a, b in known[s[0]])]
    return base, sorted(more, key=lambda s: (s[1], order[s[0]], s[2])), refused


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_ADDED = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("layers", pa.string())]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets in each row of ``docs``.

    Returns the id column, spans (kind, start, end: what the text itself shows,
    by start, then kind), added (the same and the layers unwrapped to find it:
    what no span of the text of its kind covers) and refused (compressed blocks
    that could not be unwrapped whole: beyond a limit set, in need of too much
    memory, or with a run of encoded characters longer than IN_PLACE across
    parts). Places are code points, ends exclusive. A span found
    in a compressed layer is the whole block.

    Null and empty texts have no secrets; repeated rows and ids are searched
    like others; an empty table gives no rows. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            signs = {k: pc.match_substring_regex(texts, s).to_numpy(zero_copy_only=False) for k, s in _SIGNS.items()}
            spans, added, refused = [[] for _ in range(len(texts))], [[] for _ in range(len(texts))], [0] * len(texts)
            for i in np.flatnonzero(np.logical_or.reduce(list(signs.values()))):
                kinds, decoders = [k for k in KINDS if signs[k][i]], [d for d in DECODERS if signs[d][i]]
                base, more, refused[i] = secrets_of(texts[int(i)].as_py(), kinds, decoders)
                spans[i] = [{"kind": k, "start": a, "end": b} for k, a, b in base]
                added[i] = [{"kind": k, "start": a, "end": b, "layers": p} for k, a, b, p in more]
            yield pa.record_batch([batch.column("id"), pa.array(spans, _SPANS), pa.array(added, _ADDED), pa.array(refused, pa.int64())], names=["id", "spans", "added", "refused"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, span = docs.schema[id_col].dataType.simpleString(), "kind:string,start:bigint,end:bigint"
    found = rows.mapInArrow(run, f"id {kind}, spans array<struct<{span}>>, added array<struct<{span},layers:string>>, refused bigint")
    return found.withColumnRenamed("id", id_col)


def digests(docs: DataFrame) -> DataFrame:
    """Counts and spans of each document, as text."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    place = lambda s: F.struct(s["start"].alias("start"), F.array_position(F.lit(KINDS), s["kind"]).alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    every = F.array_sort(F.concat(F.transform("spans", place), F.transform("added", place)))
    return find_secrets(docs).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(F.transform("spans", one), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(every, one), ",").alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
        "refused",
    )
