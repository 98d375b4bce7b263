"""Words of whole texts, read piece by piece so that a very long text stays bounded."""

from __future__ import annotations

import re
from collections.abc import Iterator

PIECE = 1 << 20  # bytes of a text that are held as word objects at once


class Scanner:
    """Maximal runs of a byte pattern in texts with A-Z lower-cased.

    ``run`` matches a word; ``apart`` matches one byte that is in no word, where
    a long text may be cut.
    """

    def __init__(self, run: bytes, apart: bytes):
        self.find = re.compile(run).findall
        self.cut = re.compile(apart).search

    def pieces(self, text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
        """The words of ``text`` in order, in lists of about ``size`` bytes."""
        start = 0
        while len(text) - start > size:
            end = self.cut(text, start + size)
            if end is None:
                break
            yield self.find(text[start:end.start()].lower())  # bytes.lower() is ASCII only
            start = end.end()
        yield self.find((text[start:] if start else text).lower())


#: words of letters, digits and anything beyond ASCII
def plain_words() -> Scanner:
    return Scanner(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


#: words of the letters A-Z, a-z and U+00C0 to U+00FF
def letter_runs() -> Scanner:
    return Scanner(rb"(?:[a-z]|\xC3[\x80-\xBF])+", rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
