"""Words: runs of letters, marks and digits."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

ASTRAL = re.compile("[\U00010000-\U0010ffff]")


@lru_cache(maxsize=2)
def word_pattern(top: int) -> re.Pattern:
    """Words of code points below top. A class within the basic plane is compiled to a bitmap; with others in it, it
    would be searched range by range, so those texts that need them have a pattern of their own."""
    ranges, start = [], None
    for o in range(top + 1):
        c = unicodedata.category(chr(o))
        if o < top and (c[0] in "LM" or c == "Nd"):
            start = o if start is None else start
        elif start is not None:
            ranges.append((start, o - 1))
            start = None
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]+")


def words(text: str) -> list[str]:
    return word_pattern(0x30000 if ASTRAL.search(text) else 0x10000).findall(text)
