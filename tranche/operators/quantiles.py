"""Exact quantiles at any size (linear interpolation, as ``percentile``).

Spark's exact ``percentile`` keeps every distinct value of a column in one
aggregation buffer.  Here the values' ordered bits are descended instead: a
round counts, for all columns at once, the children of the prefixes that hold
a wanted rank (16 more bits each), and a running count over a prefix's at most
65,536 children says which child holds the rank.  A child that holds one value
only (flags, small integers, ties) ends there, and a prefix with few rows is
read off at once, so no descent takes more than four rounds; a round reads the
columns that are still open.  The tasks count Arrow batches with numpy (sorted
bits, a row per child), and Spark adds their counts up.  Neither a task's
window nor the driver gets more rows than a prefix has children, whatever the
size of the table.  Values are ordered as Spark orders doubles: -inf first,
inf, then NaN; -0.0 is 0.0.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ACCURACY = 10_000        # of approximate percentiles, where a caller asks for them
ROUND_BITS = 16
READ_OFF = 1 << ROUND_BITS

_FRACTION = 52           # bits of a double's fraction; its exponent's bias is 1023
_INFINITE = 2047 << _FRACTION
_NAN = _INFINITE + (1 << (_FRACTION - 1))
_COUNTS = "t int, child long, held long, lo long, hi long"


def ordered_bits(v: Column) -> Column:
    """A long for each double, in the doubles' order (missing: missing).

    The exponent is taken from the logarithm, corrected by comparisons with
    powers of two; dividing by a power of two and scaling the rest to an
    integer are exact.
    """
    size = F.abs(v)
    a = F.when((size > 0) & (size < math.inf), size).otherwise(F.lit(1.0))
    two = F.lit(2.0)
    near = F.floor(F.log2(a))
    below = near - (a < F.pow(two, near)).cast("int")
    e = below + (a >= F.pow(two, below + 1)).cast("int")
    normal = ((e + 1023) * F.lit(1 << _FRACTION) + ((a / F.pow(two, F.greatest(e, F.lit(-1022))) - 1) * float(1 << _FRACTION)).cast("long"))
    small = (a / F.lit(math.ldexp(1.0, -1074))).cast("long")
    bits = (F.when(F.isnan(v), F.lit(_NAN)).when(size == math.inf, F.lit(_INFINITE)).when(size == 0, F.lit(0))
            .when(a < math.ldexp(1.0, -1022), small).otherwise(normal))
    return F.when(v.isNotNull(), F.when(v < 0, -bits).otherwise(bits))


def bits_of(v: np.ndarray) -> np.ndarray:
    """``ordered_bits`` of an array."""
    v = v + 0.0                             # -0.0 is 0.0
    bits = v.view(np.int64)
    bits[np.isnan(v)] = _NAN
    return np.where(bits < 0, np.iinfo(np.int64).min - bits, bits)


def value_of(bits: int) -> float:
    """The double that ``ordered_bits`` maps to ``bits``."""
    size = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -size if bits < 0 else size


def exact_quantiles(df: DataFrame, cols: list, probs: list[float], read_off: int = READ_OFF,
                    stored: bool = False) -> dict[str, list[float | None]]:
    """{column: [quantile at each prob]} over the non-missing values; ``cols``
    are names or (name, Column) pairs.  The columns are written once to the
    shared checkpoint folder, unless ``stored`` says that ``df`` is a written
    table (or a projection of one).  A prefix of at most ``read_off`` rows is
    read off at once."""
    named = [(c, F.col(c)) if isinstance(c, str) else c for c in cols]
    names = [n for n, _ in named]
    if not names or not probs:
        return {n: [None] * len(probs) for n in names}
    flat = df.select(*[c.cast("double").alias(f"v{i}") for i, (_, c) in enumerate(named)])
    if not stored:
        flat = materialize(flat, "quantile-input")
    depth, sizes, found, ranks = ROUND_BITS, {}, {}, {}
    for t, rank, n, *spot in _first_round(flat, probs):
        sizes[t], ranks[t, rank] = n, tuple(spot)
    while True:
        found |= {k: lo for k, (_, _, _, lo, hi) in ranks.items() if lo == hi}
        ranks = {k: spot for k, spot in ranks.items() if k not in found}
        if not ranks:
            break
        known, depth = depth, 64 if max(held for _, _, held, *_ in ranks.values()) <= read_off else depth + ROUND_BITS
        ranks = _next_round(flat, ranks, known, depth)
    out: dict[str, list[float | None]] = {}
    for t, name in enumerate(names):
        out[name] = [None] * len(probs)
        for j, p in enumerate(probs if t in sizes else ()):
            low, high, share = _places(sizes[t], p)
            a, b = (value_of(found[t, r]) for r in (low, high))
            out[name][j] = a if a == b or not share else a + share * (b - a)
    return out


def _places(n: int, p: float) -> tuple[int, int, float]:
    h = (n - 1) * p
    return math.floor(h), math.ceil(h), h - math.floor(h)


def _merged(child: np.ndarray, held: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple:
    """One entry per child."""
    order = np.argsort(child, kind="stable")
    child = child[order]
    at = np.flatnonzero(np.r_[True, child[1:] != child[:-1]])
    return (child[at], np.add.reduceat(held[order], at), np.minimum.reduceat(lo[order], at), np.maximum.reduceat(hi[order], at))


def _counter(depth: int, inside: dict[int, np.ndarray] | None, known: int) -> Callable[[Iterator], Iterator]:
    """Counts a task's values per column and child of ``depth`` bits, only
    those with a prefix of ``known`` bits in ``inside`` if that is given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        pending: dict[int, int] = {}
        for batch in batches:
            for name, column in zip(batch.schema.names, batch.columns):
                t = int(name[1:])
                bits = bits_of(column.drop_null().to_numpy(zero_copy_only=False))
                if inside is not None:
                    prefix = bits >> (64 - known)
                    at = np.minimum(np.searchsorted(inside[t], prefix), len(inside[t]) - 1)
                    bits = bits[inside[t][at] == prefix]
                if not len(bits):
                    continue
                bits = np.sort(bits)
                child = bits >> (64 - depth)
                first = np.flatnonzero(np.r_[True, child[1:] != child[:-1]])
                last = np.r_[first[1:], len(bits)]
                parts.setdefault(t, []).append((child[first], last - first, bits[first], bits[last - 1]))
                pending[t] = pending.get(t, 0) + len(first)
                if pending[t] > 2 * READ_OFF:
                    parts[t] = [_merged(*(np.concatenate(x) for x in zip(*parts[t])))]
                    # what has just been merged does not count again
                    pending[t] = 0
        for t, own in parts.items():
            child, *rest = _merged(*(np.concatenate(x) for x in zip(*own)))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(child), t, np.int32)), *map(pa.array, (child, *rest))],
                                             names=["t", "child", "held", "lo", "hi"])

    return count


def _counted(flat: DataFrame, depth: int, inside: dict[int, np.ndarray] | None = None, known: int = 0) -> DataFrame:
    """(t, child, held, lo, hi): rows of a child, its least and largest bits."""
    open_cols = flat.columns if inside is None else [f"v{t}" for t in sorted(inside)]
    return (flat.select(*open_cols).mapInArrow(_counter(depth, inside, known), _COUNTS).groupBy("t", "child")
            .agg(F.sum("held").alias("held"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))


def _first_round(flat: DataFrame, probs: list[float]) -> list[tuple]:
    """(t, rank, rows of t, child, rank inside the child, its rows, least and
    largest bits) of the ranks around each prob."""
    w = Window.partitionBy("t")
    counted = (_counted(flat, ROUND_BITS).withColumn("upto", F.sum("held").over(w.orderBy("child")))
               .withColumn("n", F.sum("held").over(w)))
    h = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    wanted = F.array_distinct(F.array(*[f(x).cast("long") for x in h for f in (F.floor, F.ceil)]))
    before = F.col("upto") - F.col("held")
    rows = counted.withColumn("rank", F.explode(F.filter(wanted, lambda r: (r >= before) & (r < F.col("upto"))))).collect()
    return [(r["t"], r["rank"], r["n"], r["child"], r["rank"] - (r["upto"] - r["held"]), r["held"], r["lo"], r["hi"]) for r in rows]


def _next_round(flat: DataFrame, ranks: dict, known: int, depth: int) -> dict:
    """Each rank's child of ``depth`` bits, inside its prefix of ``known``."""
    spots: dict[tuple[int, int], list] = {}
    inside: dict[int, set] = {}
    for (t, rank), (prefix, left, *_) in ranks.items():
        spots.setdefault((t, prefix), []).append((rank, left))
        inside.setdefault(t, set()).add(prefix)
    # a row per column and wanted prefix: at most two per prob
    wanted = flat.sparkSession.createDataFrame([(t, p, s) for (t, p), s in spots.items()],
                                               "t int, prefix long, spots array<struct<rank:long,left:long>>")
    counted = (_counted(flat, depth, {t: np.array(sorted(p), np.int64) for t, p in inside.items()}, known)
               .withColumn("prefix", F.shiftright("child", depth - known))
               .withColumn("upto", F.sum("held").over(Window.partitionBy("t", "prefix").orderBy("child"))))
    before = F.col("upto") - F.col("held")
    rows = (counted.join(F.broadcast(wanted), ["t", "prefix"])
            .withColumn("spot", F.explode(F.filter("spots", lambda s: (s["left"] >= before) & (s["left"] < F.col("upto")))))
            .select("t", "spot.rank", "child", (F.col("spot.left") - before).alias("left"), "held", "lo", "hi").collect())
    return {(r["t"], r["rank"]): (r["child"], r["left"], r["held"], r["lo"], r["hi"]) for r in rows}


def modes(df: DataFrame, cols: list[str]) -> dict[str, object]:
    """{column: most frequent value, the smallest of equally frequent ones}
    from counts per distinct value; None where a column has no value."""
    out: dict[str, object] = dict.fromkeys(cols)
    for kind in ("string", "double"):
        own = [c for c in cols if (df.schema[c].dataType.simpleString() == "string") == (kind == "string")]
        if own:
            parts = F.array(*[F.struct(F.lit(j).alias("t"), F.col(c).cast(kind).alias("v")) for j, c in enumerate(own)])
            counted = (df.select(F.explode(parts).alias("s")).where("s.v IS NOT NULL")
                       .groupBy(F.col("s.t").alias("t"), F.col("s.v").alias("v")).agg(F.count(F.lit(1)).alias("n")))
            for r in counted.groupBy("t").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("v"))).alias("m")).collect():
                out[own[r["t"]]] = r["m"]["v"]
    return out
