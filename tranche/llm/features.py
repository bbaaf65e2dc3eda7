"""Text features for the classifiers: hashed words and structure statistics."""

from __future__ import annotations

import numpy as np

from .common import word_hashes

STATISTICS = (
    "log_bytes", "log_words", "mean_word_bytes", "upper", "digits", "symbols", "non_ascii", "line_ends",
    "repeated_words", "top_word", "same_as_previous", "repeated_pairs", "words_ending_in_symbols", "capital_words", "bars",
)


def _per_text(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[offs[1:]] - total[offs[:-1]]).astype(float)


def _distinct(owner: np.ndarray, value: np.ndarray, n: int):
    """Distinct (owner, value) pairs: owners, values, counts; owners ascending."""
    order = np.lexsort((value, owner))
    o, v = owner[order], value[order]
    first = np.ones(len(o), bool)
    first[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(first)
    return o[at], v[at], np.diff(np.append(at, len(o)))


def text_features(data: np.ndarray, offs: np.ndarray, buckets: int):
    """Statistics (texts x STATISTICS) and word buckets as (text, bucket,
    weight): log counts, each text's weights scaled to length 1.  An empty
    text has zero statistics and no buckets."""
    n = len(offs) - 1
    h, s, e, first = word_hashes(data, offs)
    words = np.diff(first).astype(float)
    owner = np.repeat(np.arange(n), np.diff(first))
    size = np.maximum(offs[1:] - offs[:-1], 1).astype(float)
    w = np.maximum(words, 1)
    ascii_ = data < 128
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    symbol = ascii_ & (data > 32) & ~upper & ~lower & ~digit

    o, v, c = _distinct(owner, h, n)
    distinct = np.bincount(o, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, o, c)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    inside = owner[1:] == owner[:-1]
    po, _, _ = _distinct(owner[1:][inside], (h[1:] * np.uint64(3) ^ (h[:-1] * np.uint64(0x9E3779B97F4A7C15)))[inside], n)
    pairs = np.maximum(words - 1, 1)
    last = symbol[e - 1]
    capital = upper[s] & (upper[np.minimum(s + 1, e - 1)] | (e - s == 1))
    stats = np.column_stack([
        np.log1p(offs[1:] - offs[:-1]), np.log1p(words), _per_text(np.ones(len(data), bool), offs) / w,
        _per_text(upper, offs) / size, _per_text(digit, offs) / size, _per_text(symbol, offs) / size,
        _per_text(~ascii_, offs) / size, _per_text(data == 10, offs) / size,
        (1 - distinct / w) * (words > 0), top / w, np.bincount(owner, same, n) / w,
        (1 - np.bincount(po, minlength=n) / pairs) * (words > 1),
        np.bincount(owner, last, n) / w, np.bincount(owner, capital, n) / w, _per_text(data == 124, offs) / size,
    ]) if n else np.empty((0, len(STATISTICS)))

    bo, bv, bc = _distinct(owner, (h % np.uint64(buckets)).astype(np.int64), n)
    weight = np.log1p(bc)
    length = np.sqrt(np.bincount(bo, weight * weight, n))
    return stats, bo, bv, weight / np.maximum(length[bo], 1e-12)
