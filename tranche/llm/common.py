"""Helpers shared by the operators: Arrow text access, hashes, storage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    return materialize(df, f"llm-{name}")


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Sub-batches holding at most ``limit`` bytes of ``column`` (one row at
    least), so that temporaries stay bounded whatever the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offs = utf8(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column without gaps and its n + 1 offsets; null: empty."""
    col = col.fill_null("") if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else col.fill_null(b"")
    col = col.cast(pa.large_binary())
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def text_key(col="text"):
    """128 bits of SHA-256 naming a text's content (null: empty)."""
    return F.substring(F.unhex(F.sha2(F.coalesce(F.col(col), F.lit("")), 256)), 1, 16)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values (vectorised)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_table(seed: int) -> tuple[np.ndarray, np.uint64]:
    """Random 64-bit value of each byte and an odd multiplier."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**64, 256, dtype=np.uint64), np.uint64(int(rng.integers(0, 2**64, dtype=np.uint64)) | 1)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


def inverse64(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 2**64))


def word_hashes(data: np.ndarray, offs: np.ndarray, seed: int = 7, lower: bool = True):
    """Words ``[^\\x20\\x09-\\x0D]+`` of several texts laid end to end.

    Returns the 64-bit hash of each word (A-Z lowered if asked), each word's
    start and end byte, and for each text the index of its first word
    (n + 1 entries).  Vectorised: one pass of prefix sums over the bytes.
    """
    n = len(data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    start = np.empty(n, bool)
    end = np.empty(n, bool)
    if n:
        start[0] = not space[0]
        start[1:] = ~space[1:] & space[:-1]
        end[-1] = not space[-1]
        end[:-1] = ~space[:-1] & space[1:]
        cut = offs[1:-1][(offs[1:-1] < n) & (offs[1:-1] > 0)]   # texts never run into each other
        start[cut] = ~space[cut]
        end[cut - 1] = ~space[cut - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    table, base = byte_table(seed)
    if lower:
        table = table.copy()
        table[65:91] = table[97:123]
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(table[data] * powers(base, n), out=acc[1:])
    inv = powers(inverse64(base), n + 1)
    h = mix64((acc[e] - acc[s]) * inv[s] + (e - s).astype(np.uint64))
    return h, s, e, np.searchsorted(s, offs)

