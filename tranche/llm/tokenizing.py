"""Byte-level byte-pair ids, as the tokenizers library gives them.

The library itself encodes about 1.3 MB a second and core.  The same
vocabulary as ranks (the ``.tiktoken`` file beside the ``.json`` one) gives
the same ids five times faster, so texts for which both libraries' splitting
rules are known to agree take that road: no special string inside, no code
point from U+0240 up (where the libraries' Unicode tables may differ), no run
of over ``LONGEST_RUN`` bytes with or without white space.  Every other text
goes through the tokenizers library.  Tests hold both roads together.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa

from .common import utf8

LONGEST_RUN = 1000
_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
_LOADED: dict[str, "ByteBpe"] = {}


class ByteBpe:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.ranks = None
        by_rank = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(by_rank):   # a vocabulary file of the installation, the same on every machine
            import public_tokenizers
            import tiktoken
            with open(by_rank, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, col: pa.Array) -> list[np.ndarray]:
        """Ids of each text (null: empty) without added special tokens."""
        texts = [t or "" for t in col.to_pylist()]
        plain = self._plain(col, texts) if self.ranks is not None else np.zeros(len(texts), bool)
        rest = [i for i in range(len(texts)) if not plain[i]]
        slow = dict(zip(rest, self.library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False))) if rest else {}
        return [np.array(slow[i].ids, np.uint32) if i in slow else self.ranks.encode_to_numpy(texts[i], disallowed_special=())
                for i in range(len(texts))]

    def _plain(self, col: pa.Array, texts: list[str]) -> np.ndarray:
        data, offs = utf8(col)
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(offs, np.flatnonzero(data >= 0xC9), side="right") - 1] = True
        # runs are not cut at the texts' ends: one that is too long makes every text it touches odd
        space = _SPACE[data]
        turn = np.concatenate([[0], np.flatnonzero(space[1:] != space[:-1]) + 1, [len(data)]])
        for k in np.flatnonzero(np.diff(turn) > LONGEST_RUN).tolist():
            odd[np.searchsorted(offs, turn[k], side="right") - 1:np.searchsorted(offs, turn[k + 1], side="left")] = True
        return np.array([not o and not any(s in t for s in self.special) for o, t in zip(odd, texts)], bool)


def byte_bpe(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]
