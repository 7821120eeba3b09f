"""Words of a text as runs of bytes, and numbering of the words of many texts."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np


def byte_table(digits: bool) -> bytes:
    """Translation of UTF-8 bytes: A-Z in lower case, a-z (0-9 too with ``digits``)
    and all bytes of characters beyond ASCII as they are, the rest a space."""
    out = bytearray(b" " * 256)
    for b in range(256):
        if 97 <= b <= 122 or b >= 128 or (digits and 48 <= b <= 57):
            out[b] = b
        elif 65 <= b <= 90:
            out[b] = b + 32
    return bytes(out)


class Numbering(defaultdict):
    """Numbers words from 0 in the order in which they first come."""

    def __init__(self) -> None:
        super().__init__(count().__next__)

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))
