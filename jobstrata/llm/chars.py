"""Classes of code points, as a table that numpy reads."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

BLANK, LETTER, NUMBER, OTHER, SPECIAL = range(5)
FIRST_SPECIAL = 0xD800  # lone surrogates cannot occur in a text and stand in for special tokens

# Unicode white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    everything = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, everything):
            out[found.start() : found.end()] = kind
    out[[ord(x) for x in WHITE]] = BLANK
    out[FIRST_SPECIAL:0xDC00] = SPECIAL
    return out


def points_of(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
