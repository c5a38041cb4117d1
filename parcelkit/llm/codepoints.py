"""Code point classes of Unicode, built once per process from the standard library's tables."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: The code points with the Unicode property White_Space.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
               0x205F, 0x3000)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point (uint8): letter (L*), number (N*), white space or other."""
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    # Planes above the third hold no letters or numbers.
    table[:0x40000] = [kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x40000)]
    table[list(WHITE_SPACE)] = SPACE
    return table


def charset(kind: int) -> str:
    """The class as ranges for a character set of a regular expression."""
    inside = np.flatnonzero(np.diff(np.concatenate([[0], classes() == kind, [0]]).astype(np.int8)))
    return "".join(f"\\U{a:08x}" if a == b - 1 else f"\\U{a:08x}-\\U{b - 1:08x}"
                   for a, b in zip(inside[::2].tolist(), inside[1::2].tolist(), strict=True))
