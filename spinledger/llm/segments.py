"""Words of texts of any length, worked through in pieces of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator

# Bytes of a piece at least; it ends before the next white space.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, limit: int = PIECE) -> Iterator[bytes]:
    """Consecutive parts of a text, cut before white space only, so that no word is parted."""
    at = 0
    while len(text) - at > limit:
        cut = _SPACE.search(text, at + limit)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text
