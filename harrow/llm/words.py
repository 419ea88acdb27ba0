"""Words of a text as byte strings, piece by piece, so that a very long text never becomes one list."""

from __future__ import annotations

from collections.abc import Iterator

PIECE_BYTES = 4 << 20


def _table(is_word) -> bytes:
    """Byte map: A-Z lowered, bytes outside words made spaces."""
    return bytes((b + 32 if 65 <= b <= 90 else b) if is_word(b) else 32 for b in range(256))


#: Runs without ASCII white space, A-Z lowered.
SOLID = _table(lambda b: b != 32 and not 9 <= b <= 13)
#: Runs of ASCII letters and bytes beyond ASCII, A-Z lowered.
LETTERS = _table(lambda b: b >= 128 or 65 <= b <= 90 or 97 <= b <= 122)


def word_lists(text: bytes, table: bytes, piece: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of `text` in lists, cut between words after about `piece` bytes; at least one list."""
    if len(text) <= piece:
        yield text.translate(table).split()
        return
    at, rest = 0, b""
    while at < len(text):
        part = rest + text[at : at + piece].translate(table)
        at += piece
        cut = part.rfind(b" ") + 1 if at < len(text) else len(part)
        part, rest = part[:cut], part[cut:]
        yield part.split()
