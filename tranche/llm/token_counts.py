"""Token counts of a byte-pair model without producing token ids (operator 4).

The text is normalised by the model's own library and cut into segments that
no vocabulary piece can span (before a run of word marks that follows another
character, if no piece has a mark inside).  Each segment is merged with a
heap over a linked list of symbols: the adjacent pair whose joined piece ranks
lowest is popped, merged, and its two new neighbours are pushed.  A segment's
count is its initial symbols minus its merges, plus the extra byte tokens of
characters outside the vocabulary.  Counts of segments are kept in a bounded
per-worker table, so common words are merged once per worker.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, slices, utf8

MARK = "▁"
CACHE_ENTRIES = 1_000_000
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_MODELS: dict[str, "PieceCounter"] = {}


class PieceCounter(dict):
    """Segment -> token count; missing segments are merged and remembered."""

    def __init__(self, model_path: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = self.library.get_piece_size()
        self.rank, self.bytes_ok = {}, False
        for i in range(n):
            if self.library.is_byte(i):
                self.bytes_ok = True
            elif self.library.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            elif not (self.library.is_control(i) or self.library.is_unknown(i)):
                self.rank[self.library.id_to_piece(i)] = -self.library.get_score(i)
        # a piece with a mark after another character would join two segments
        self.splits = not any(a != MARK and b == MARK for p in self.rank for a, b in zip(p, p[1:]))
        self.alone = self._absent_from_long_pieces("\n")

    def _absent_from_long_pieces(self, ch: str) -> bool:
        return not any(ch in p for p in self.rank if len(p) > 1)

    def __missing__(self, segment: str) -> int:
        if self.alone and "\n" in segment:   # no piece holds a line end: its sides merge apart
            parts = segment.split("\n")
            n = sum(self[p] for p in parts if p) + (len(parts) - 1) * self.merged("\n")
        else:
            n = self.merged(segment)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[segment] = n
        return n

    def merged(self, text: str) -> int:
        """Initial symbols minus merges, with byte tokens for unknown characters."""
        n, rank = len(text), self.rank
        get = rank.get
        end = list(range(1, n + 1))          # end of the symbol that starts here; 0: merged away
        begin = list(range(-1, n))           # start of the symbol that ends here
        heap = []
        for i in range(n - 1):
            r = get(text[i:i + 2])
            if r is not None:
                heap.append((r, i, i + 2))
        heapify(heap)
        count = n
        while heap:
            _, i, e = heappop(heap)
            mid = end[i]
            if not mid or mid >= e or end[mid] != e:
                continue
            end[i], end[mid], begin[e] = e, 0, i
            count -= 1
            if i:
                p = begin[i]
                r = get(text[p:e])
                if r is not None:
                    heappush(heap, (r, p, e))
            if e < n:
                q = end[e]
                r = get(text[i:q])
                if r is not None:
                    heappush(heap, (r, i, q))
        if self.bytes_ok:
            for i in range(n):
                if end[i] == i + 1 and text[i] not in rank:
                    count += len(text[i].encode()) - 1
        return count

    def count(self, text: str) -> int:
        """Tokens the library gives for ``text`` without begin or end tokens."""
        if not text:
            return 0
        marked = self.library.normalize(text)
        if not marked:
            return 0
        if not self.bytes_ok:
            # without byte tokens neighbouring unknown characters fuse: left to the library
            return len(self.library.encode(text))
        if not self.splits:
            return self.merged(marked)
        return sum(map(self.__getitem__, _SEGMENT.findall(marked)))


def counter(model_path: str) -> PieceCounter:
    if model_path not in _MODELS:
        _MODELS[model_path] = PieceCounter(model_path)
    return _MODELS[model_path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row.

    Null texts count as empty (0 bytes, 0 tokens).  Rows with repeated or null
    ids are each counted; other columns are not read.  A narrow map: no
    shuffle, and a lost task recounts its rows alone.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        c = counter(model_path)
        for b in slices(batches):
            data, offs = utf8(b.column("text"))
            counts = [c.count(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(offs[1:] - offs[:-1], pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of documents under the 32k piece model."""
    import public_tokenizers
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
