"""Long texts in slices, so that no list of words of a whole book is held at once."""

from __future__ import annotations

import re
from collections.abc import Iterator


def slices(text: bytes, gap: re.Pattern[bytes], size: int = 1 << 22) -> Iterator[bytes]:
    """``text`` cut before the first ``gap`` after each ``size`` bytes. Joined they are the text."""
    at = 0
    while len(text) - at > size:
        found = gap.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text
