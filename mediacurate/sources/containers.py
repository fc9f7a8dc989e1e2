"""Whether a picture's container is whole: its segments or chunks are walked by their lengths, from the start to the end that they say.

A marker counts only where the container puts one, so the end of an embedded thumbnail is not the end of the picture, and data after
the end are no damage. Reads are bounded: a JPEG's segments are stepped over and only its scans are searched, a PNG's chunks go
through the checksum piece by piece, of a WebP only chunk headers are read.
"""

from __future__ import annotations

import re
import zlib

# Signatures, markers and chunk names of the formats.
JPEG_START = b"\xff\xd8\xff"
PNG_START = b"\x89PNG\r\n\x1a\n"
RIFF, WEBP = b"RIFF", b"WEBP"
JPEG_END, JPEG_SCAN = 0xD9, 0xDA
JPEG_ALONE = (0x01, 0xD8)
PNG_FIRST, PNG_DATA, PNG_LAST = b"IHDR", b"IDAT", b"IEND"
WEBP_FRAME, WEBP_FRAME_START = b"VP8 ", b"\x9d\x01\x2a"
WEBP_LOSSLESS, WEBP_LOSSLESS_START = b"VP8L", b"\x2f"

#: Within a scan, FF is followed by 00, by a restart marker or by more FF; anything else is a marker.
_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_WINDOW = 64 << 10
_MOST_READ = 1 << 20


class Held:
    """Bytes at hand, read like a file."""

    def __init__(self, body: bytes):
        self.body = body

    def size(self) -> int:
        return len(self.body)

    def read_at(self, n: int, at: int) -> bytes:
        return self.body[at : at + n]


class _Window:
    """Small reads of a file served out of larger ones."""

    def __init__(self, source):
        self.source, self.size = source, source.size()
        self.at, self.held = 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``, fewer at the end of the file only."""
        if not (self.at <= at and at + n <= self.at + len(self.held)):
            take = max(0, min(max(n, _WINDOW), self.size - at))
            self.at, self.held = at, self.source.read_at(take, at) if take else b""
        return self.held[at - self.at : at - self.at + n]


def _next_marker(window: _Window, at: int) -> tuple[int, int] | None:
    """The first marker from ``at`` on: where it ends, and its code."""
    step = _WINDOW
    while at + 1 < window.size:
        piece = window.read(at, step)
        found = _MARKER.search(piece)
        if found:
            return at + found.end(), piece[found.end() - 1]
        at += max(1, len(piece) - 1)  # a marker may lie across two pieces
        step = min(step * 4, _MOST_READ)
    return None


def _jpeg_problem(window: _Window) -> str | None:
    at, scans = 2, 0
    while True:
        found = _next_marker(window, at)
        if found is None:
            return "truncated_jpeg"
        at, code = found
        if code == JPEG_END:
            return None if scans else "truncated_jpeg"
        if code in JPEG_ALONE:
            continue
        length = int.from_bytes(window.read(at, 2), "big")
        if at + max(length, 2) > window.size:
            return "truncated_jpeg"
        if length < 2:
            return "bad_segment"
        at += length
        scans += code == JPEG_SCAN


def _png_problem(window: _Window) -> str | None:
    at, data = len(PNG_START), False
    while True:
        header = window.read(at, 8)
        length, kind = int.from_bytes(header[:4], "big"), header[4:]
        if len(header) < 8 or at + 12 + length > window.size:
            return "truncated_png"
        if (at == len(PNG_START)) != (kind == PNG_FIRST):
            return "bad_chunk"
        checksum, place, end = zlib.crc32(kind), at + 8, at + 8 + length
        while place < end:
            piece = window.read(place, min(_MOST_READ, end - place))
            checksum = zlib.crc32(piece, checksum)
            place += len(piece)
        if checksum != int.from_bytes(window.read(end, 4), "big"):
            return "bad_crc"
        data = data or kind == PNG_DATA
        if kind == PNG_LAST:
            return None if data else "truncated_png"
        at = end + 4


def _webp_problem(window: _Window) -> str | None:
    end = 8 + int.from_bytes(window.read(4, 4), "little")
    if end > window.size:
        return "truncated_webp"
    at = 12
    while at + 8 <= end:
        header = window.read(at, 18)
        kind, length = header[:4], int.from_bytes(header[4:8], "little")
        if at + 8 + length > end:
            return "truncated_webp"
        if kind == WEBP_FRAME and header[11:14] != WEBP_FRAME_START or kind == WEBP_LOSSLESS and header[8:9] != WEBP_LOSSLESS_START:
            return "bad_chunk"
        at += 8 + length + length % 2  # chunks are filled up to an even length
    return None if 12 < at <= end + 1 else "truncated_webp"


def inspect(source) -> tuple[str | None, str | None]:
    """Format told by content, and what is wrong or null; ``source`` has ``size()`` and ``read_at(n, at)``."""
    window = _Window(source)
    head = window.read(0, 12)
    if not window.size:
        return None, "missing_or_empty"
    if head.startswith(JPEG_START):
        return "jpeg", _jpeg_problem(window)
    if head.startswith(PNG_START):
        return "png", _png_problem(window)
    if head.startswith(RIFF) and head[8:] == WEBP:
        return "webp", _webp_problem(window)
    return None, "unknown_format"
