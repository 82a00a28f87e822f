"""Words of whole texts as bytes, in bounded lists."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of text that are split into words at once.
PIECE = 1 << 20


def kept_bytes(keep: str) -> bytes:
    """A translation table: A-Z to a-z, the bytes of ``keep`` (Latin-1) as they are, all others to spaces."""
    kept = set(keep.encode("latin-1"))
    return bytes(c + 32 if 65 <= c <= 90 else c if c in kept else 32 for c in range(256))


def word_lists(data: bytes, table: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of about ``piece`` bytes; a word is never cut."""
    data = data.translate(table)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
