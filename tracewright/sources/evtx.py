"""Binary event logs (EVTX): a decoder of one 64 KB chunk at a time, and an encoder for small logs.

A chunk stands on its own: its names, and the templates that its records fill in, are at offsets within it. So
chunks are read by different tasks, and a damaged one costs its own records only. A template is parsed once a chunk into text
and places for values; a record is then its template's text with its values put in.

The layout is that of the published description of the format (file header, chunk header, records, binary XML).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from typing import NamedTuple

FILE_HEADER, CHUNK, CHUNK_HEADER = 4096, 1 << 16, 512
FILE_MAGIC, CHUNK_MAGIC, RECORD_MAGIC = b"ElfFile\0", b"ElfChnk\0", b"\x2a\x2a\0\0"
RECORD_HEADER = 24
_EPOCH = datetime(1601, 1, 1)

#: Tokens of binary XML; MORE marks elements with attributes, and values that more follow.
END, OPEN, CLOSE_START, CLOSE_EMPTY, CLOSE, VALUE, ATTRIBUTE, CDATA, CHAR, ENTITY, PI_TARGET, PI_DATA, TEMPLATE, SUBSTITUTION, OPTIONAL, FRAGMENT = range(16)
MORE = 0x40
#: Types of values.
NULL, STRING, ANSI = 0, 1, 2
_NUMBERS = {3: "<b", 4: "<B", 5: "<h", 6: "<H", 7: "<i", 8: "<I", 9: "<q", 10: "<Q", 11: "<f", 12: "<d"}
BOOL, BINARY, GUID, SIZE, FILETIME, SYSTEMTIME, SID, HEX32, HEX64, XML = 13, 14, 15, 16, 17, 18, 19, 20, 21, 33
ARRAY = 0x80
_WIDTHS = {t: struct.calcsize(f) for t, f in _NUMBERS.items()} | {BOOL: 4, GUID: 16, FILETIME: 8, SYSTEMTIME: 16, HEX32: 4, HEX64: 8}
DEEPEST = 64

_ESCAPES = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;"}
#: What XML 1.0 has no place for is left out.
_ESCAPED = str.maketrans(_ESCAPES | {chr(c): "" for c in (*range(9), 11, 12, *range(14, 32), 0xFFFE, 0xFFFF, *range(0xD800, 0xE000))})
_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


class Damaged(ValueError):
    """Bytes that are not what the format has at their place."""


class Record(NamedTuple):
    """A record of a chunk; of damaged ones (and of a whole damaged chunk) xml is None and error says why."""

    record_id: int | None
    written: datetime | None
    xml: str | None
    error: str | None


class Slot(NamedTuple):
    """A place for value number `index`."""

    index: int


class Attribute(NamedTuple):
    """An attribute; it is left out if its only part is a slot without a value."""

    name: str
    parts: tuple[str | Slot, ...]


Part = str | Slot | Attribute


def file_time(value: int) -> datetime | None:
    try:
        return _EPOCH + timedelta(microseconds=value // 10)
    except OverflowError:
        return None


class Chunk:
    """The records of one chunk."""

    def __init__(self, data: bytes):
        self.data = data
        self.names: dict[int, str] = {}
        self.templates: dict[int, tuple[list[Part], int]] = {}

    def unpack(self, layout: str, at: int) -> tuple:
        try:
            return struct.unpack_from(layout, self.data, at)
        except struct.error:
            raise Damaged(f"cut off at {at}") from None

    def records(self) -> Iterator[Record]:
        """All records in order; one that cannot be decoded does not touch those after it."""
        if self.data[:8] != CHUNK_MAGIC or len(self.data) < CHUNK_HEADER:
            if any(self.data):
                yield Record(None, None, None, "no chunk")
            return
        (end,) = self.unpack("<I", 48)
        at, end = CHUNK_HEADER, min(end, len(self.data))
        while at + RECORD_HEADER <= end:
            if self.data[at : at + 4] != RECORD_MAGIC:
                yield Record(None, None, None, f"no record at {at}")
                return
            size, record_id, written = self.unpack("<IQQ", at + 4)
            if size < RECORD_HEADER + 4 or at + size > len(self.data):
                yield Record(record_id, None, None, f"size of record at {at}")
                return
            try:
                out: list[str] = []
                self.fragment(at + RECORD_HEADER, at + size - 4, out)
                yield Record(record_id, file_time(written), "".join(out), None)
            except (Damaged, RecursionError) as e:
                yield Record(record_id, file_time(written), None, str(e))
            at += size

    def name(self, at: int) -> str:
        if at not in self.names:
            _, _, n = self.unpack("<IHH", at)
            self.names[at] = self.text(at + 8, n)
        return self.names[at]

    def text(self, at: int, n: int) -> str:
        raw = self.data[at : at + 2 * n]
        if len(raw) < 2 * n:
            raise Damaged(f"text cut off at {at}")
        return raw.decode("utf-16-le", "replace")

    def named(self, at: int) -> tuple[str, int]:
        """The name that the offset at `at` points to, and where reading goes on: after the name if it stands right here."""
        (offset,) = self.unpack("<I", at)
        at += 4
        name = self.name(offset)
        return name, at + 10 + len(name.encode("utf-16-le")) if offset == at else at

    def fragment(self, at: int, end: int, out: list[str], depth: int = 0) -> None:
        """The XML of a fragment: a template with its values, or elements."""
        if depth > DEEPEST:
            raise Damaged("nested too deep")
        while at < end and self.data[at] == FRAGMENT:
            at += 4
        if at < end and self.data[at] & ~MORE == TEMPLATE:
            parts, at = self.template(at)
            values = self.values(at, end, depth)
            self.filled(parts, values, out)
        elif at < end and self.data[at] != END:
            parts, _ = self.parsed(at, end)
            self.filled(parts, [], out)

    def template(self, at: int) -> tuple[list[Part], int]:
        """Parts of the template of an instance, and where its values begin."""
        _, _, offset = self.unpack("<BII", at + 1)
        at += 10
        if offset not in self.templates:
            (size,) = self.unpack("<I", offset + 20)
            start = offset + 24
            parts, _ = self.parsed(start + 4 if self.data[start : start + 1] == bytes([FRAGMENT]) else start, start + size)
            self.templates[offset] = parts, start + size
        parts, after = self.templates[offset]
        return parts, after if offset == at else at

    def values(self, at: int, end: int, depth: int) -> list[str | None]:
        (n,) = self.unpack("<I", at)
        at += 4
        if at + 4 * n > end:
            raise Damaged(f"{n} values at {at}")
        kinds = [self.unpack("<HB", at + 4 * i) for i in range(n)]
        at += 4 * n
        out: list[str | None] = []
        for size, kind in kinds:
            if at + size > end:
                raise Damaged(f"value cut off at {at}")
            out.append(self.value(kind, at, size, depth))
            at += size
        return out

    def value(self, kind: int, at: int, size: int, depth: int) -> str | None:
        """A value as escaped text, a nested fragment as XML; None for no value."""
        if kind == NULL or not size:
            return None
        if kind == XML:
            out: list[str] = []
            self.fragment(at, at + size, out, depth + 1)
            return "".join(out)
        raw = self.data[at : at + size]
        if kind & ARRAY:
            return ", ".join(_array(kind & ~ARRAY, raw))
        return _shown(kind, raw)

    def parsed(self, at: int, end: int) -> tuple[list[Part], int]:
        """Elements up to the end of the fragment as text and slots."""
        parts: list[Part] = []
        open_elements: list[str] = []
        while at < end:
            token = self.data[at] & ~MORE
            if token == END:
                at += 1
                break
            if token == OPEN:
                attributes = self.data[at] & MORE
                name, at = self.named(at + 7)
                at += 4 if attributes else 0
                open_elements.append(name)
                parts.append(f"<{name}")
            elif token == ATTRIBUTE:
                name, at = self.named(at + 1)
                own: list[str | Slot] = []
                while at < end and self.data[at] & ~MORE in (VALUE, SUBSTITUTION, OPTIONAL, CHAR, ENTITY):
                    piece, at = self.piece(at)
                    own.append(piece)
                parts.append(Attribute(name, tuple(own)))
            elif token == CLOSE_START:
                parts.append(">")
                at += 1
            elif token in (CLOSE_EMPTY, CLOSE):
                if not open_elements:
                    raise Damaged(f"nothing to close at {at}")
                name = open_elements.pop()
                parts.append("/>" if token == CLOSE_EMPTY else f"</{name}>")
                at += 1
            elif token in (VALUE, SUBSTITUTION, OPTIONAL, CHAR, ENTITY, CDATA):
                piece, at = self.piece(at)
                parts.append(piece)
            elif token == PI_TARGET:
                _, at = self.named(at + 1)
            elif token == PI_DATA:
                (n,) = self.unpack("<H", at + 1)
                at += 3 + 2 * n
            elif token == FRAGMENT:
                at += 4
            else:
                raise Damaged(f"token {token} at {at}")
        if open_elements:
            raise Damaged("elements stay open")
        return _joined(parts), at

    def piece(self, at: int) -> tuple[str | Slot, int]:
        """One piece of content, escaped, or a slot."""
        token = self.data[at] & ~MORE
        if token in (SUBSTITUTION, OPTIONAL):
            (index,) = self.unpack("<H", at + 1)
            return Slot(index), at + 4
        if token == VALUE:
            kind, n = self.unpack("<BH", at + 1)
            if kind != STRING:
                raise Damaged(f"text of type {kind} at {at}")
            return self.text(at + 4, n).translate(_ESCAPED), at + 4 + 2 * n
        if token == CDATA:
            (n,) = self.unpack("<H", at + 1)
            return self.text(at + 3, n).translate(_ESCAPED), at + 3 + 2 * n
        if token == CHAR:
            (code,) = self.unpack("<H", at + 1)
            return chr(code).translate(_ESCAPED), at + 3
        name, at = self.named(at + 1)
        return _ENTITIES.get(name, "").translate(_ESCAPED), at

    def filled(self, parts: list[Part], values: list[str | None], out: list[str]) -> None:
        """Text of parts with the values in their slots."""

        def of(slot: Slot) -> str | None:
            if slot.index >= len(values):
                raise Damaged(f"no value {slot.index}")
            return values[slot.index]

        for part in parts:
            if isinstance(part, str):
                out.append(part)
            elif isinstance(part, Slot):
                out.append(of(part) or "")
            else:
                own = [p if isinstance(p, str) else of(p) for p in part.parts]
                if any(x is not None for x in own):
                    out.append(f' {part.name}="{"".join(x or "" for x in own)}"')


def _joined(parts: list[Part]) -> list[Part]:
    """Neighbouring texts as one."""
    out: list[Part] = []
    for part in parts:
        if isinstance(part, str) and out and isinstance(out[-1], str):
            out[-1] += part
        else:
            out.append(part)
    return out


def _shown(kind: int, raw: bytes) -> str:
    """A value as escaped text."""
    if kind == STRING:
        return raw.decode("utf-16-le", "replace").rstrip("\0").translate(_ESCAPED)
    if kind == ANSI:
        return raw.decode("cp1252", "replace").rstrip("\0").translate(_ESCAPED)
    if kind in _WIDTHS and len(raw) < _WIDTHS[kind]:
        raise Damaged(f"value of type {kind} has {len(raw)} bytes")
    if kind in _NUMBERS:
        return str(struct.unpack_from(_NUMBERS[kind], raw)[0])
    if kind == BOOL:
        return "true" if any(raw[:4]) else "false"
    if kind == GUID:
        return f"{{{str(uuid.UUID(bytes_le=raw[:16])).upper()}}}"
    if kind == FILETIME:
        at = file_time(int.from_bytes(raw[:8], "little"))
        return at.strftime("%Y-%m-%dT%H:%M:%S.%fZ") if at else ""
    if kind == SYSTEMTIME:
        year, month, _, day, hour, minute, second, milli = struct.unpack_from("<8H", raw)
        return f"{year:04}-{month:02}-{day:02}T{hour:02}:{minute:02}:{second:02}.{milli:03}Z"
    if kind == SID:
        return _sid(raw)
    if kind in (HEX32, HEX64, SIZE):
        return f"0x{int.from_bytes(raw[:8], 'little'):x}"
    return raw.hex().upper()


def _sid(raw: bytes) -> str:
    if len(raw) < 8 or len(raw) < 8 + 4 * raw[1]:
        raise Damaged("security identifier cut off")
    return "-".join(["S", str(raw[0]), str(int.from_bytes(raw[2:8], "big")), *map(str, struct.unpack_from(f"<{raw[1]}I", raw, 8))])


def _array(kind: int, raw: bytes) -> list[str]:
    if kind == STRING:
        return [s.translate(_ESCAPED) for s in raw.decode("utf-16-le", "replace").rstrip("\0").split("\0")]
    width = _WIDTHS.get(kind)
    return [_shown(kind, raw[i : i + width]) for i in range(0, len(raw), width)] if width else [raw.hex().upper()]


# ---- encoding


class Event(NamedTuple):
    """What a record of a small log says."""

    record_id: int
    written: datetime
    event_id: int
    data: tuple[tuple[str, str | None], ...]


NAMESPACE = "http://schemas.microsoft.com/win/2004/08/events/event"
PROVIDER, COMPUTER = "Tracewright", "localhost"


class Encoder:
    """One chunk: names and templates are written where they are first used, later uses point to them."""

    def __init__(self, first_record: int):
        self.data = bytearray(CHUNK_HEADER)
        self.names: dict[str, int] = {}
        self.templates: dict[tuple[str, ...], int] = {}
        self.first, self.ids, self.last_at = first_record, [], 0

    def name(self, text: str) -> None:
        at = len(self.data)
        if text in self.names:
            self.data += struct.pack("<I", self.names[text])
            return
        self.names[text] = at + 4
        h = 0
        for c in text:
            h = (h * 65599 + ord(c)) & 0xFFFFFFFF
        self.data += struct.pack("<IIHH", at + 4, 0, h & 0xFFFF, len(text)) + text.encode("utf-16-le") + b"\0\0"

    def sized(self, write) -> None:
        """What `write` adds, behind its size."""
        at = len(self.data)
        self.data += bytes(4)
        write()
        struct.pack_into("<I", self.data, at, len(self.data) - at - 4)

    def element(self, name: str, attributes: tuple[tuple[str, str | int], ...] = (), content=None) -> None:
        self.data += struct.pack("<BH", OPEN | (MORE if attributes else 0), 0xFFFF)

        def inside() -> None:
            self.name(name)
            if attributes:
                self.sized(lambda: [self.attribute(k, v, i < len(attributes) - 1) for i, (k, v) in enumerate(attributes)])
            if content is None:
                self.data.append(CLOSE_EMPTY)
                return
            self.data.append(CLOSE_START)
            content()
            self.data.append(CLOSE)

        self.sized(inside)

    def attribute(self, name: str, value: str | int, more: bool) -> None:
        self.data.append(ATTRIBUTE | (MORE if more else 0))
        self.name(name)
        self.content(value)

    def content(self, value: str | int, kind: int = STRING) -> None:
        """Text, or a slot by its number."""
        if isinstance(value, int):
            self.data += struct.pack("<BHB", OPTIONAL, value, kind)
        else:
            self.data += struct.pack("<BBH", VALUE, STRING, len(value)) + value.encode("utf-16-le")

    def template(self, names: tuple[str, ...]) -> None:
        """A template instance up to its values: slots 0 to 2 are the EventID, the record and the time, the rest data."""
        self.data += struct.pack("<BBI", TEMPLATE, 1, zlib.crc32("|".join(names).encode()))
        at = len(self.data)
        if names in self.templates:
            self.data += struct.pack("<I", self.templates[names])
            return
        self.templates[names] = at + 4
        self.data += struct.pack("<II", at + 4, 0) + uuid.uuid5(uuid.NAMESPACE_OID, "|".join(names)).bytes_le

        def system() -> None:
            self.element("Provider", (("Name", PROVIDER),))
            self.element("EventID", content=lambda: self.content(0, 6))
            self.element("EventRecordID", content=lambda: self.content(1, 10))
            self.element("TimeCreated", (("SystemTime", 2),))
            self.element("Computer", content=lambda: self.content(COMPUTER))

        def event() -> None:
            self.element("System", content=system)
            self.element("EventData", content=lambda: [self.element("Data", (("Name", n),), lambda i=i: self.content(3 + i)) for i, n in enumerate(names)])

        def body() -> None:
            self.data += bytes([FRAGMENT, 1, 1, 0])
            self.element("Event", (("xmlns", NAMESPACE),), event)
            self.data.append(END)

        self.sized(body)

    def add(self, event: Event) -> None:
        at = len(self.data)
        ticks = (event.written - _EPOCH) // timedelta(microseconds=1) * 10
        self.data += RECORD_MAGIC + struct.pack("<IQQ", 0, event.record_id, ticks) + bytes([FRAGMENT, 1, 1, 0])
        self.template(tuple(n for n, _ in event.data))
        values = [(6, struct.pack("<H", event.event_id)), (10, struct.pack("<Q", event.record_id)), (FILETIME, struct.pack("<Q", ticks))]
        values += [(NULL, b"") if v is None else (STRING, v.encode("utf-16-le")) for _, v in event.data]
        if any(len(raw) >= CHUNK for _, raw in values):
            raise ValueError(f"record {event.record_id} is larger than a chunk")
        self.data += struct.pack("<I", len(values)) + b"".join(struct.pack("<HBB", len(raw), kind, 0) for kind, raw in values) + b"".join(raw for _, raw in values)
        self.data.append(END)
        size = len(self.data) - at + 4
        self.data += struct.pack("<I", size)
        struct.pack_into("<I", self.data, at + 4, size)
        self.ids.append(event.record_id)
        self.last_at = at

    def bytes(self) -> bytes:
        """The chunk with its header and checksums."""
        free = len(self.data)
        out = self.data + bytes(CHUNK - free)
        struct.pack_into("<8sQQQQIIII", out, 0, CHUNK_MAGIC, self.first, self.first + len(self.ids) - 1, min(self.ids), max(self.ids), 128, self.last_at, free, zlib.crc32(out[CHUNK_HEADER:free]))
        struct.pack_into("<I", out, 124, zlib.crc32(out[:120] + out[128:CHUNK_HEADER]))
        return bytes(out)


def encoded(events: Iterable[Event]) -> bytes:
    """A log file of the events; an event that no chunk has room for is an error."""
    chunks: list[bytes] = []
    n, now = 0, None
    for event in events:
        now = now or Encoder(n + 1)
        before = len(now.data), dict(now.names), dict(now.templates), list(now.ids), now.last_at
        now.add(event)
        if len(now.data) > CHUNK:
            now.data, (now.names, now.templates, now.ids, now.last_at) = now.data[: before[0]], before[1:]
            if now.ids:
                chunks.append(now.bytes())
            now = Encoder(n + 1)
            now.add(event)
            if len(now.data) > CHUNK:
                raise ValueError(f"record {event.record_id} is larger than a chunk")
        n += 1
    if now is not None and now.ids:
        chunks.append(now.bytes())
    head = bytearray(FILE_HEADER)
    struct.pack_into("<8sQQQIHHHH", head, 0, FILE_MAGIC, 0, max(0, len(chunks) - 1), n + 1, 128, 1, 3, FILE_HEADER, len(chunks))
    struct.pack_into("<I", head, 124, zlib.crc32(head[:120]))
    return bytes(head) + b"".join(chunks)
