"""Word shingles of texts as sorted distinct 64-bit hashes (vectorised)."""

from __future__ import annotations

import numpy as np

from .common import mix64, word_hashes

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``words`` words of several texts laid end to end:
    the hashes, ascending within each text, and n + 1 offsets.  A text with
    fewer words is one shingle; a text without words has none."""
    n = len(offs) - 1
    h, _, _, first = word_hashes(data, offs)
    count = np.diff(first)
    owner = np.repeat(np.arange(n), count)
    place = np.arange(len(h)) - first[owner] if len(h) else np.empty(0, np.int64)
    whole = place + words <= count[owner]                  # a shingle starts here
    short = (place == 0) & (count[owner] < words)          # or the whole text does
    value = h.copy()
    for k in range(1, words):
        nxt = np.zeros_like(h)
        nxt[:-k or None] = h[k:]
        inside = place + k < count[owner]
        value = np.where(inside, mix64(value * _STEP + nxt), value)
    value = np.where(short, mix64(value + count[owner].astype(np.uint64)), value)
    keep = whole | short
    owner, value = owner[keep], value[keep]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(n + 1))
