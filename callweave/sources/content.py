"""Records out of the content of one file, as streams in bounded memory.

Each function takes the content as an iterator of byte chunks and yields records, lists of (name, text)
pairs in record order. Damaged content raises, whatever the kind of exception; none of these functions touches
storage."""

from __future__ import annotations

import codecs
import csv
import io
import json
import sys
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

Pairs = list[tuple[str, str | None]]
Chunks = Iterator[bytes]

CHUNK = 1 << 20


def chunks_of(content: bytes) -> Chunks:
    view = memoryview(content)
    return (bytes(view[a : a + CHUNK]) for a in range(0, len(content), CHUNK))


def fault(bad: Exception) -> str:
    """What an error row says."""
    return f"{type(bad).__name__}: {bad}"[:1000].encode("utf-8", "replace").decode()


# --------------------------------------------------------------------------
# JSON
# --------------------------------------------------------------------------
_BLANK = " \t\n\r"


def _plain(text: str) -> str:
    """Text without halves of signs, which no table can hold."""
    return text if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def json_text(value: object) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value).lower()
    return _plain(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":")))


def json_pairs(found: object) -> Pairs:
    if not isinstance(found, dict):
        raise ValueError("no array of objects")
    return [(_plain(k), json_text(v)) for k, v in found.items()]


def json_object(text: str) -> Pairs:
    """The record that ``text`` is, and nothing else."""
    return json_pairs(json.loads(text, parse_int=str, parse_float=str, parse_constant=str))


class _Text:
    """Decoded text of a stream, from the place that is read next."""

    def __init__(self, chunks: Chunks):
        self.chunks, self.text, self.at, self.decoder = chunks, "", 0, None
        self.raw = json.JSONDecoder(parse_int=str, parse_float=str, parse_constant=str).raw_decode

    def more(self) -> bool:
        """At least as much again as is there, so that long records cost in proportion to their length."""
        wanted, parts, size = len(self.text) - self.at, [self.text[self.at :]], 0
        while size <= wanted and self.chunks is not None:
            data = next(self.chunks, None)
            if self.decoder is None:
                self.decoder = codecs.getincrementaldecoder(json.detect_encoding(data or b""))("surrogatepass")
            parts.append(self.decoder.decode(data or b"", data is None))
            size += len(parts[-1])
            if data is None:
                self.chunks = None
        self.text, self.at = "".join(parts), 0
        return size > 0

    def sign(self) -> str:
        """The next sign that is no white space, or nothing at the end."""
        while True:
            while self.at < len(self.text):
                if self.text[self.at] not in _BLANK:
                    return self.text[self.at]
                self.at += 1
            if not self.more():
                return ""

    def value(self) -> object:
        while True:
            try:
                found, past = self.raw(self.text, self.at)
            except json.JSONDecodeError as bad:
                # cut off by the end of what is read so far, or wrong in itself
                cut = bad.msg.startswith("Unterminated string") or bad.pos >= len(self.text) - 16
                if not cut or not self.more():
                    raise
                continue
            self.at = past
            return found


def json_records(chunks: Chunks) -> Iterator[Pairs]:
    """The objects of one array."""
    text = _Text(chunks)
    if text.sign() != "[":
        raise ValueError("no array of objects")
    text.at += 1
    sign = text.sign()
    while sign != "]":
        if sign != "{":
            raise ValueError("no array of objects")
        yield json_pairs(text.value())
        sign = text.sign()
        if sign not in (",", "]"):
            raise ValueError("array is cut off or damaged")
        if sign == ",":
            text.at += 1
            sign = text.sign()
            if sign == "]":
                raise ValueError("array ends in a comma")
    text.at += 1
    if text.sign():
        raise ValueError("content after the array")


def unzipped(chunks: Chunks) -> Chunks:
    """The content of a gzip stream of one or more members, checked; chunks of bounded size."""
    unpack, begun = zlib.decompressobj(31), False
    for data in chunks:
        while data:
            if unpack.eof:
                data = data.lstrip(b"\0")  # padding between members
                if not data:
                    break
                unpack = zlib.decompressobj(31)
            out = unpack.decompress(data, CHUNK)
            begun = True
            data = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            if out:
                yield out
    if begun and not unpack.eof:
        raise EOFError("gzip stream is cut off")


def gzip_records(chunks: Chunks) -> Iterator[Pairs]:
    return json_records(unzipped(chunks))


# --------------------------------------------------------------------------
# CSV in zip archives
# --------------------------------------------------------------------------
def _csv_rows(lines: Iterator[str]) -> Iterator[Pairs]:
    csv.field_size_limit(min(sys.maxsize, (1 << 63) - 1))
    for row in csv.DictReader(lines):
        yield [(k, v if v != "" else None) for k, v in row.items() if k is not None]


class _Stream(io.RawIOBase):
    def __init__(self, chunks: Chunks):
        self.chunks, self.rest = chunks, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.rest:
            data = next(self.chunks, None)
            if data is None:
                return 0
            self.rest = data
        n = min(len(buffer), len(self.rest))
        buffer[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def zip_records(chunks: Chunks) -> Iterator[Pairs]:
    """Rows of the first entry, by the archive's directory; the packed bytes are held."""
    with zipfile.ZipFile(io.BytesIO(b"".join(chunks))) as archive:
        with archive.open(archive.namelist()[0]) as entry:
            yield from _csv_rows(io.TextIOWrapper(entry, encoding="utf-8", newline=""))


def _first_entry(chunks: Chunks) -> Chunks:
    """The unpacked bytes of the entry that an archive begins with, read front to back."""
    data = b""

    def need(n: int) -> None:
        nonlocal data
        parts, size = [data], len(data)
        while size < n:
            more = next(chunks, None)
            if more is None:
                raise zipfile.BadZipFile("archive is cut off")
            parts.append(more)
            size += len(more)
        data = b"".join(parts)

    def number(a: int, n: int) -> int:
        return int.from_bytes(data[a : a + n], "little")

    need(30)
    if data[:4] != b"PK\3\4":
        raise zipfile.BadZipFile("File is not a zip file")
    flags, method, crc, packed = number(6, 2), number(8, 2), number(14, 4), number(18, 4)
    names, extras = number(26, 2), number(28, 2)
    need(30 + names + extras)
    at, past = 30 + names, 30 + names + extras
    wide = False
    while at + 4 <= past:  # the sizes of large entries
        kind, size = number(at, 2), number(at + 2, 2)
        if kind == 1 and size >= 16:
            wide, packed = True, number(at + 12, 8)
        at += 4 + size
    later = bool(flags & 8)  # sizes and checksum follow the entry
    if flags & 1:
        raise RuntimeError("entry is encrypted")
    if method not in (0, 8) or method == 0 and later:
        raise NotImplementedError(f"packing method {method} of a streamed entry")
    data, seen = data[past:], 0
    unpack = zlib.decompressobj(-15)
    while not unpack.eof if method else packed > 0:
        if not data:
            need(1)
        if method:
            out = unpack.decompress(data, CHUNK)
            data = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
        else:
            out, data = data[:packed], data[packed:]
            packed -= len(out)
        seen = zlib.crc32(out, seen)
        yield out
    if later:
        need(24 if wide else 16)
        crc = number(4, 4) if data[:4] == b"PK\7\x08" else number(0, 4)
    if seen != crc:
        raise zipfile.BadZipFile("bad checksum of the first entry")


def zip_stream_records(chunks: Chunks) -> Iterator[Pairs]:
    """As ``zip_records``, front to back without holding the archive, whose first entry must come first in it."""
    raw = io.BufferedReader(_Stream(_first_entry(chunks)), CHUNK)
    yield from _csv_rows(io.TextIOWrapper(raw, encoding="utf-8", newline=""))


# --------------------------------------------------------------------------
# XML
# --------------------------------------------------------------------------
def xml_records(chunks: Chunks, row_tag: str) -> Iterator[Pairs]:
    """Elements of ``row_tag`` at any depth below the root; what has been passed is let go."""
    parser = ElementTree.XMLPullParser(("start", "end"))
    above: list = []
    inside = 0  # open records

    def found() -> Iterator[Pairs]:
        nonlocal inside
        for event, element in parser.read_events():
            if event == "start":
                inside += bool(above) and element.tag == row_tag
                above.append(element)
                continue
            above.pop()
            if above and element.tag == row_tag:
                inside -= 1
                values = {child.tag: child.text for child in element}  # the last of equal names holds the value
                yield [(k, None if v in (None, "", "None") else v) for k, v in values.items()]
                del element[:]
            if above and not inside:
                del above[-1][:]

    for data in chunks:
        parser.feed(data)
        yield from found()
    parser.close()
    yield from found()
