"""Packing token sequences by non-negative least squares (operator 3).

Only the histogram of piece lengths reaches the driver (one row per length,
at most the capacity).  Patterns of up to three lengths that fill a sequence
exactly are enumerated, a non-negative least squares fit finds how often each
should repeat so that together they use the histogram, the counts are rounded
down to what the histogram still holds, and what is left is packed longest
first into the tightest open space.  Pieces then take places by their number
within their length, which a salted distributed numbering gives.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, slices, stored
from .numbering import rank_within
from .tokenizing import byte_bpe

CAPACITY = 1024
THREE_UP_TO = 2048          # longer capacities use patterns of two lengths
STEPS = 1500


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 2) -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32: every text's ids and
    ``end_id``, cut into whole pieces from its end (the first may be shorter)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        bpe, uid = byte_bpe(tokenizer_path), TaskContext.get().partitionId() << 33
        for b in slices(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(bpe.encode(b.column("text"))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                at = 0
                for k in range(-(-len(ids) // capacity)):
                    to = at + ((len(ids) - at) % capacity or capacity)
                    row.append(i), piece.append(k), start.append(at), length.append(to - at)
                    crc.append(zlib.crc32(ids[at:to]))
                    at = to
            n = len(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + n)), b.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["uid", "doc_id", "piece", "start", "length", "ids_crc32"])
            uid += n

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        cut, f"uid long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def exact_patterns(present: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c, of lengths present that sum to the
    capacity; c, or b and c, may be 0 (absent)."""
    have = np.zeros(capacity + 1, bool)
    have[present] = True
    have[0] = True
    found = []
    for a in range(capacity, 0, -1):
        if not have[a]:
            continue
        rest = capacity - a
        least = 0 if capacity <= THREE_UP_TO else max(rest, 0)
        b = np.arange(max(-(-rest // 2), least), min(a, rest) + 1)
        b = b[have[b] & have[rest - b]]
        found.append(np.column_stack([np.full(len(b), a), b, rest - b]))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeats x >= 0 that minimise the squared difference between the lengths
    the patterns use and the histogram (accelerated projected gradient)."""
    n, size = len(patterns), len(histogram)
    flat = patterns.ravel()

    def used(x):
        u = np.bincount(flat, np.repeat(x, 3), size)
        u[0] = 0
        return u

    def back(r):
        return r[patterns].sum(1)

    v = np.ones(n)
    for _ in range(30):                      # largest eigenvalue: the step's bound
        v = back(used(v))
        v /= np.linalg.norm(v) or 1
    step = 1 / max(np.linalg.norm(back(used(v))), 1e-9) / 1.05
    target = histogram.astype(float)
    target[0] = 0
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * back(used(y) - target))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if np.dot(y - new, new - x) > 0:     # momentum points uphill: start it anew
            t_new, y = 1.0, new
        else:
            y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences), using every piece."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        counts[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    if counts[capacity]:
        plan.append(((capacity,), int(counts[capacity])))
        counts[capacity] = 0
    patterns = exact_patterns(np.flatnonzero(counts), capacity)
    if len(patterns):
        x = fit_repeats(patterns, counts)
        for exact in (True, False):          # whole repeats first, then the fractions' halves
            for i in np.argsort(-x, kind="stable"):
                want = int(x[i]) if exact else int(x[i] + 0.5) - int(x[i])
                if not want:
                    continue
                lengths = [int(v) for v in patterns[i] if v]
                n = min([want, *(int(counts[v]) // lengths.count(v) for v in lengths)])
                if n > 0:
                    for v in lengths:
                        counts[v] -= n
                    plan.append((tuple(lengths), n))
    return plan + pack_residual(counts, capacity)


def pack_residual(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first into the tightest open space; equal sequences are one
    entry with a count, so the work follows the histogram, not the pieces."""
    spaces: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            space = next((s for s in range(length, capacity) if spaces[s]), None)
            if space is None:
                per = capacity // length     # none open: whole sequences of this length
                whole, odd = divmod(left, per)
                for k, n in ((per, whole), (odd, 1)):
                    if k and n:
                        room = spaces[capacity - k * length]
                        room[(length,) * k] = room.get((length,) * k, 0) + n
                left = 0
                break
            lengths, n = spaces[space].popitem()
            take = min(n, left)
            if take < n:
                spaces[space][lengths] = n - take
            room = spaces[space - length]
            room[(*lengths, length)] = room.get((*lengths, length), 0) + take
            left -= take
    return [(lengths, n) for s in sorted(spaces) for lengths, n in spaces[s].items()]


def place(numbered: DataFrame, plan: list[tuple[tuple[int, ...], int]]) -> DataFrame:
    """Adds sequence_id and offset from each piece's ``rank`` within its length."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)   # length -> (first rank, first sequence, offset)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for lengths, n in plan:
        at = 0
        for v in lengths:
            runs[v].append((taken[v], sequence, at))
            taken[v] += n
            at += v
        sequence += n
    table = {v: np.array(r, np.int64) for v, r in runs.items()}
    names = [c for c in numbered.columns if c != "rank"]
    schema = ", ".join(f"`{c}` {numbered.schema[c].dataType.simpleString()}" for c in names) + ", sequence_id long, offset long"

    def assign(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(group):
                    t = table[int(length[group[0]])]
                    k = np.searchsorted(t[:, 0], rank[group], side="right") - 1
                    seq[group], off[group] = t[k, 1] + rank[group] - t[k, 0], t[k, 2]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    return numbered.mapInArrow(assign, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row
    per piece.

    Null and empty texts give one piece of the end token.  Repeated or null
    ids are packed row by row; other columns are not read.  An empty table
    gives no rows.  Texts are tokenised once: pieces are stored, and the
    histogram and the numbering read that table.
    """
    cut = stored(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}   # at most ``capacity`` rows
    return place(rank_within(cut, "length", "uid"), pack_histogram(histogram, capacity)).drop("uid")


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in sequences of at most 1024 tokens."""
    import public_tokenizers
    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
