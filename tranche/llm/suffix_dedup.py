"""Removal of repeated byte strings with a sparse suffix array (operator 1).

Every string of LENGTH bytes has an anchor: of its GRAM-byte substrings the
one with the smallest hash.  Equal strings have equal anchors at equal places,
so only suffixes that begin at anchors need sorting.  Anchors whose hash does
not repeat are dropped; the strings around the others (a context: all strings
of one anchor, at most 2 * LENGTH bytes) meet by anchor hash.  There the
suffixes are put in order by deep-shallow sorting, and walking the order's
intervals of common prefixes from the longest to the shortest, together with
the order of what stands before the anchors, gives every string that starts
anywhere else as well.  Contexts that occur twice as a whole need no sorting,
and contexts of a very frequent anchor are compared string by string instead,
as digests that are aggregated before the shuffle, so no group grows with the
data.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_intermediates
from .common import byte_table, inverse64, mix64, powers, read, slices, stored, text_key, utf8
from .jaccard_join import bit_filter
from .suffix_sort import common_prefix, deep_shallow_order

LENGTH = 400
GRAM = 64
MOST_CONTEXTS = 4096     # distinct contexts of one anchor that are sorted in one group (3 MB)
SLICE = 1 << 20
_TABLE, _BASE = byte_table(11)


@lru_cache(maxsize=1)
def _powers(n: int):
    return powers(_BASE, n), powers(inverse64(_BASE), n)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the gram that starts at each byte (len - gram + 1)."""
    n = len(data)
    size = 1 << max(16, int(n).bit_length())
    up, down = _powers(size)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[:n], out=acc[1:])
    return mix64((acc[gram:] - acc[:n - gram + 1]) * down[:n - gram + 1])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from minima of blocks."""
    n = len(x)
    pad = -n % width
    y = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(y, axis=1).ravel()
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchored(data: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """Runs of string starts that share an anchor: text, anchor hash, first
    start, last start and anchor place (all in bytes of ``data``)."""
    n, width = len(data), length - gram + 1
    none = np.empty(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none, none, none
    h = gram_hashes(data, gram)
    # 32 hash bits decide, then the place: the leftmost of equal ones
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_least(key, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(anchor))
    text = np.searchsorted(offs, start, side="right") - 1
    inside = start + length <= offs[text + 1]
    start, text, anchor = start[inside], text[inside], anchor[inside]
    if not len(start):
        return none, none.astype(np.uint64), none, none, none
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    last = start[np.append(at[1:], len(start)) - 1]
    return text[at], h[anchor[at]], start[at], last, anchor[at]


def repeated_starts(contexts: list[bytes], anchors: list[int], length: int, gram: int) -> list[list[tuple[int, int]]]:
    """For each of several distinct contexts of one anchor hash: the ranges of
    starts (first, last) of strings that also occur in another context.

    The string with x bytes before the anchor is common to two contexts if
    they agree on x bytes before it and length - x bytes from it.  Intervals
    of the sorted suffixes are merged by falling common prefix, the smaller
    into the larger; a context only has to meet its two neighbours, in the
    order of what stands before the anchor, of the set it is merged into: any
    other would share less on both sides.
    """
    m = len(contexts)
    after = [c[a:] for c, a in zip(contexts, anchors)]
    before = [c[:a][::-1] for c, a in zip(contexts, anchors)]
    found: list[list[tuple[int, int]]] = [[] for _ in range(m)]

    def meet(i: int, j: int, depth: int) -> None:
        least = max(length - depth, 0)
        shared = common_prefix(before[i], before[j])
        if shared >= least:
            for k in (i, j):
                first = max(anchors[k] - shared, 0)
                last = min(anchors[k] - least, len(contexts[k]) - length)
                if first <= last:
                    found[k].append((first, last))

    if m == 2:
        meet(0, 1, common_prefix(after[0], after[1]))
        return found
    order = deep_shallow_order(after)
    by_left = deep_shallow_order(before)
    place = [0] * m
    for r, i in enumerate(by_left):
        place[i] = r
    depths = [common_prefix(after[a], after[b]) for a, b in zip(order, order[1:])]
    parent = list(range(m))                  # positions in ``order`` -> their set
    sets = [[place[i]] for i in order]

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k in sorted(range(m - 1), key=lambda k: -depths[k]):
        if depths[k] < gram:                 # only a hash collision brought them together
            break
        low, high = sorted((root(k), root(k + 1)), key=lambda r: len(sets[r]))
        big = sets[high]
        for r in sets[low]:
            at = bisect_left(big, r)
            if at:
                meet(by_left[r], by_left[big[at - 1]], depths[k])
            if at < len(big):
                meet(by_left[r], by_left[big[at]], depths[k])
        sets[high] = sorted(big + sets[low])
        sets[low] = []
        parent[low] = high
    return found


def merged(ranges: list[tuple[int, int]], gap: int = 1) -> list[tuple[int, int]]:
    """Union of inclusive ranges; ranges up to ``gap`` apart become one."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + gap:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _once(batches, limit: int = SLICE):
    """Slices without the texts that this task has met before."""
    seen = set()
    for b in slices(batches, limit=limit):
        new = [i for i, k in enumerate(b.column("tkey").to_pylist()) if k not in seen and not seen.add(k)]
        if new:
            yield b if len(new) == b.num_rows else b.take(pa.array(new))


def _tags(keys: list[bytes], text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """64 bits naming a place of a text: equal for copies of the text."""
    k = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)[:, 0]
    return mix64(k[text] + place.astype(np.uint64) * _BASE).view(np.int64)


def repeated_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """h: anchor hashes found at more than one place of the distinct texts."""
    def run(batches):
        for b in _once(batches):
            data, offs = utf8(b.column("text"))
            text, h, _, _, anchor = anchored(data, offs, length, gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(_tags(b.column("tkey").to_pylist(), text, anchor - offs[text]))], ["h", "tag"])

    return (texts.mapInArrow(run, "h long, tag long").groupBy("h").agg(F.min("tag").alias("lo"), F.max("tag").alias("hi"))
            .where("lo <> hi").select("h"))


def contexts_of(texts: DataFrame, bits: np.ndarray, size: int, length: int, gram: int) -> DataFrame:
    """A row per run of starts whose anchor hash passes the bit filter: tkey,
    first (start in the text), tag, h, cid (128 bits naming context and anchor
    place), anchor (place in the context), ctx (null if the slice has it already)."""
    def run(batches):
        for b in _once(batches):
            data, offs = utf8(b.column("text"))
            text, h, first, last, anchor = anchored(data, offs, length, gram)
            at = (h & np.uint64(size - 1)).astype(np.int64)
            hit = np.flatnonzero(bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
            text, h, first, last, anchor = (x[hit] for x in (text, h, first, last, anchor))
            keys = b.column("tkey").to_pylist()
            cid, ctx, met, raw = [], [], set(), data.tobytes()
            for a, z, p in zip(first.tolist(), last.tolist(), anchor.tolist()):
                c = raw[a:z + length]
                d = hashlib.blake2b(c, digest_size=16, salt=(p - a).to_bytes(4, "little")).digest()
                cid.append(d)
                ctx.append(None if d in met else c)
                met.add(d)
            yield pa.RecordBatch.from_arrays(
                [b.column("tkey").take(pa.array(text)), pa.array(first - offs[text]), pa.array(_tags(keys, text, first - offs[text])),
                 pa.array(h.view(np.int64)), pa.array(cid, pa.binary()), pa.array((anchor - first).astype(np.int32)), pa.array(ctx, pa.binary())],
                ["tkey", "first", "tag", "h", "cid", "anchor", "ctx"])

    return texts.mapInArrow(run, "tkey binary, first long, tag long, h long, cid binary, anchor int, ctx binary")


def sorted_marks(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """cid, first, last of the repeated starts, by sorting each anchor hash's
    contexts (at most MOST_CONTEXTS of them)."""
    def groups(batches):
        held_h, held = None, []
        for b in batches:
            for h, cid, anchor, ctx in zip(*(b.column(c).to_pylist() for c in ("h", "cid", "anchor", "ctx"))):
                if h != held_h and held:
                    yield held
                    held = []
                held_h = h
                held.append((cid, anchor, ctx))
        if held:
            yield held

    def run(batches):
        out: list[tuple[bytes, int, int]] = []
        for g in groups(batches):
            for (cid, _, _), ranges in zip(g, repeated_starts([x[2] for x in g], [x[1] for x in g], length, gram)):
                out += [(cid, a, z) for a, z in merged(ranges)]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["cid", "first", "last"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["cid", "first", "last"])

    return (contexts.select("h", "cid", "anchor", "ctx").repartition("h").sortWithinPartitions("h")
            .mapInArrow(run, "cid binary, first long, last long"))


def counted_marks(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with more contexts: every string of a context as a
    digest; a digest that two contexts have marks its start in each."""
    def run(batches):
        for b in batches:
            for cid, ctx in zip(b.column("cid").to_pylist(), b.column("ctx").to_pylist()):
                n = len(ctx) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.blake2b(ctx[p:p + length], digest_size=16).digest() for p in range(n)], pa.binary()),
                     pa.array([cid] * n, pa.binary()), pa.array(np.arange(n))], ["string", "cid", "first"])

    strings = contexts.select("cid", "ctx").mapInArrow(run, "string binary, cid binary, first long")
    twice = strings.groupBy("string").agg(F.min(F.xxhash64("cid")).alias("lo"), F.max(F.xxhash64("cid")).alias("hi")).where("lo <> hi").select("string")
    return strings.join(twice, "string").select("cid", "first", F.col("first").alias("last"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """tkey, spans: the maximal byte ranges [from, to) of each distinct text
    (columns tkey and text; copies of a text count once) whose every byte is
    covered by a string of ``length`` bytes that starts at another place of
    the distinct texts as well.  Texts without such a range have no row."""
    with run_intermediates() as own:
        found = _covered(texts, length, gram)
    spans = stored(found, "spans")
    own.release(texts.sparkSession)
    return spans


def _covered(texts: DataFrame, length: int, gram: int) -> DataFrame:
    found = stored(repeated_anchors(texts, length, gram), "anchors")
    bits, size = bit_filter(found, lambda n: F.col("h").bitwiseAND(n - 1), found.count())
    places = stored(contexts_of(texts, bits, size, length, gram), "places")
    contexts = stored(places.groupBy("cid").agg(
        F.first("h").alias("h"), F.first("anchor").alias("anchor"), F.first("ctx", ignorenulls=True).alias("ctx"),
        (F.min("tag") != F.max("tag")).alias("twice")), "contexts")
    sizes = contexts.groupBy("h").agg(F.count("*").alias("n"), F.max(~F.col("twice")).alias("open")).where("n > 1 AND open")
    shared = contexts.join(sizes, "h")
    whole = contexts.where("twice").select("cid", F.lit(0).cast("long").alias("first"), (F.length("ctx") - length).cast("long").alias("last"))
    marks = (whole.union(sorted_marks(shared.where(F.col("n") <= MOST_CONTEXTS), length, gram))
             .union(counted_marks(shared.where(F.col("n") > MOST_CONTEXTS), length)))

    def join_up(batches):
        for b in batches:
            spans = [merged([(x["a"], x["z"]) for x in s], gap=0) for s in b.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("tkey"), pa.array([[{"a": a, "z": z} for a, z in s] for s in spans], pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())])))],
                ["tkey", "spans"])

    ranges = marks.groupBy("cid").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))      # at most as many as the context has starts
    spans = places.select("tkey", "cid", F.col("first").alias("at")).join(ranges, "cid").select(
        "tkey", F.transform("ranges", lambda r: F.struct((F.col("at") + r["first"]).alias("a"), (F.col("at") + r["last"] + length).alias("z"))).alias("part"))
    return (spans.groupBy("tkey").agg(F.flatten(F.collect_set("part")).alias("found"))               # at most as many as the text has starts
            .mapInArrow(join_up, "tkey binary, spans array<struct<a: bigint, z: bigint>>"))


def _keep(raw: bytes, spans: list[dict]) -> bytes:
    at, out = 0, []
    for s in spans:
        out.append(raw[at:s["a"]])
        at = s["z"]
    return b"".join([*out, raw[at:]])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), text_key().alias("tkey"))


def removal_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row.

    Every byte covered by a ``length``-byte string that also starts anywhere
    else goes: in another row, or elsewhere in the same one.  A text that two
    rows share goes whole if it is long enough.  Null texts are empty.
    Repeated and null ids are rows like others; an empty table gives no rows.
    """
    rows = _keyed(docs)
    texts = rows.select("tkey", "text")
    copies = rows.groupBy("tkey").agg(F.count("*").alias("copies"))
    spans = stored(repeated_spans(texts, length).join(copies.where("copies = 1"), "tkey").select("tkey", "spans"), "own-spans")
    bits, size = bit_filter(spans, lambda n: F.pmod(F.xxhash64("tkey"), F.lit(n)), spans.count())

    def passing(batches):
        for b in batches:
            at = b.column("at").to_numpy()
            yield b.select(["tkey", "text"]).filter(pa.array((bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)))

    def cut(batches):
        for b in slices(batches):
            kept = [_keep(t.encode(), s) for t, s in zip(b.column("text").to_pylist(), b.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("tkey"), pa.array([sum(x["z"] - x["a"] for x in s) for s in b.column("spans").to_pylist()], pa.int64()),
                 pa.array([len(s) for s in b.column("spans").to_pylist()], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                ["tkey", "removed", "found", "kept"])

    marked = texts.withColumn("at", F.pmod(F.xxhash64("tkey"), F.lit(size))).mapInArrow(passing, "tkey binary, text string")
    results = marked.join(spans, "tkey").mapInArrow(cut, "tkey binary, removed long, found long, kept string")
    slim = rows.select("doc_id", "tkey", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    empty = hashlib.sha256(b"").hexdigest()
    return slim.join(copies, "tkey").join(results, "tkey", "left").select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("found", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(empty)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text``.

    Rows that share a whole text of at least ``length`` bytes, and rows of
    which no byte is left, are dropped; other rows stay, null and empty texts
    as they are.  Where a cut divides a character, its bytes that are left are
    dropped.  ``n_chars``, if there, follows the new text.
    """
    keyed = docs.withColumn("__tkey", text_key())
    texts = _keyed(docs).select("tkey", "text")
    copies = texts.groupBy("tkey").agg(F.count("*").alias("__copies"))
    found = copies.join(repeated_spans(texts, length), "tkey", "left").where("__copies > 1 OR spans IS NOT NULL").select(
        F.col("tkey").alias("__tkey"), "__copies", F.col("spans").alias("__spans"))
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cut(batches):
        for b in slices(batches):
            text, keep = [], []
            for t, s, c in zip(*(b.column(x).to_pylist() for x in ("text", "__spans", "__copies"))):
                raw = (t or "").encode()
                gone = c is not None and c > 1 and len(raw) >= length
                t = t if s is None or gone else _keep(raw, s).decode("utf-8", "ignore")
                text.append(t)
                keep.append(not gone and (s is None or t != ""))
            out = [pa.array(text, pa.string()) if n == "text" else
                   pa.array([len(t) if t is not None and s is not None else x for t, s, x in zip(text, b.column("__spans").to_pylist(), b.column(n).to_pylist())], b.column(n).type)
                   if n == "n_chars" else b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(out, names).filter(pa.array(keep))

    return keyed.join(found, "__tkey", "left").select(*names, "__spans", "__copies").mapInArrow(cut, schema)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, strings of 400 bytes."""
    return removal_digest(read(spark, sf_dir, "documents"))
