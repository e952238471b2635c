"""Unicode classes spelled out as ranges, for splitting patterns of tokenizers.

Regular expression engines differ on the white space 1C-1F and on code points
that are not assigned; tokenizers go by the assigned ones alone.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import regex

#: Unicode white space.
WHITE_SPACE = "\t-\r" + "".join(map(chr, (
    0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


#: The first code point that is not assigned: engines agree on the letters and numbers before it.
FIRST_UNASSIGNED = "\u0378"


@lru_cache
def unicode_class(initial: str, below: int = sys.maxunicode + 1) -> str:
    """The code points whose category begins with a letter, as ranges for a bracket expression."""
    inside = [unicodedata.category(chr(c))[0] == initial for c in range(below)]
    edges = [c for c in range(len(inside) + 1) if (c and inside[c - 1]) != (c < len(inside) and inside[c])]
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))


def spelled(pattern: str, classes=unicode_class) -> str:
    r"""The pattern with ``\s``, ``\S``, ``\p{L}`` and ``\p{N}`` replaced by what they stand for."""
    def ranges(name: str) -> str:
        return WHITE_SPACE if name.lower() == r"\s" else classes(name[3])

    def put(match: regex.Match) -> str:
        part = match[0]
        if part.startswith("["):
            return regex.sub(r"\\p\{[LN]\}|\\s", lambda m: ranges(m[0]), part)
        return f"[{'^' if part == chr(92) + 'S' else ''}{ranges(part)}]"

    return regex.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\[sS]", put, pattern)


class Splitter:
    """The matches of a pattern as tokenizers find them, by short classes where these say the same."""

    def __init__(self, pattern: str, every: str):
        self.ascii = re.compile(spelled(pattern, {"L": "A-Za-z", "N": "0-9"}.get).replace(WHITE_SPACE, "\t-\r "))
        self.early = re.compile(spelled(pattern, lambda initial: unicode_class(initial, ord(FIRST_UNASSIGNED))))
        self.every = regex.compile(every)
        self.late = re.compile(f"[^\0-{chr(ord(FIRST_UNASSIGNED) - 1)}]")

    def quick(self, text: str) -> bool:
        """Whether short classes say the same for this text."""
        return not self.late.search(text)

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        return (self.early if self.quick(text) else self.every).findall(text)
